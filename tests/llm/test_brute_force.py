"""Token counts across blocks, shards and slots, the mixture's prefix, and a whole pipeline run, against plain loops."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from meterhawk.llm import bpe, mixing, near_dedup, quality, sharding, token_counts  # noqa: E402
from meterhawk.llm.common import Scratch  # noqa: E402
from meterhawk.llm.queries import MIXTURE, VOCABULARY  # noqa: E402


@pytest.mark.parametrize(("block", "run"), [(7, 3), (1, 2), (64, 1)])
def test_documents_are_stitched_across_blocks_and_runs(spark, monkeypatch, block, run):
    monkeypatch.setattr(token_counts, "RUN_BLOCKS", run)
    rng = np.random.default_rng(block)
    sizes = [int(n) for n in rng.integers(0, 30, 120)] + [0, 0, 500, 0]
    rows = [(i // 2 if i % 9 else None, rng.integers(0, 50, n).astype("<u4").tobytes(), n) for i, n in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, ids binary, n long").repartition(3)
    scratch = Scratch(spark, "t")
    _, blocks, manifest = token_counts.write_flat(docs.select("doc_id", "ids"), 50, scratch, block_tokens=block)
    counted = token_counts.count_tokens(blocks, 50, scratch)
    files, places = defaultdict(list), {}
    for r in blocks.orderBy("file", "number").collect():
        files[r.file] += np.frombuffer(r.tokens, "<u2").tolist()
    for file, ids in files.items():
        start, place = 0, 0
        for at, value in enumerate(ids):
            if value == 50:
                places[file, place] = (start, at - start)
                start, place = at + 1, place + 1
        assert start == len(ids)
    assert {(r.file, r.place): (r.start, r.n_tokens) for r in counted.collect()} == places
    named = counted.join(manifest, ["file", "place"]).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in named) == sorted((i or -1, n) for i, _, n in rows)


@pytest.mark.parametrize("shards", [1, 7, 16])
def test_shard_and_slot_follow_from_the_row_number(spark, shards):
    rows = [(i % 90 if i % 11 else None, "same" if i % 3 else f"text {i}", i) for i in range(200)] + [(5, None, 0)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, slot int")
    placed = sharding.shard_rows(docs, shards)
    number, at = F.col("row_number"), F.col("slot") * shards + F.col("shard")
    told = placed.select("*", sharding.permute(number, len(rows)).alias("at"), sharding.restore(at, len(rows)).alias("back")).collect()
    assert sorted(r.row_number for r in told) == list(range(len(rows)))
    assert sorted(r.slot * shards + r.shard for r in told) == list(range(len(rows)))
    assert all(r["at"] == r.slot * shards + r.shard and r.back == r.row_number for r in told)
    again = sharding.shard_rows(docs.repartition(5, "text"), shards).collect()
    assert sorted(map(str, placed.collect())) == sorted(map(str, again))


def _mixed(rows, share, epochs, seed):
    """(row, epoch) of each taking: leaves' budgets filled by whole epochs and a prefix in the order of the keys."""
    leaves, totals = defaultdict(list), defaultdict(int)
    for row in rows:
        tokens = len((row["text"] or "").split())
        if tokens:
            name = "null" if row["source"] is None else row["source"]
            leaf = (row["domain"], "null" if row["lang"] is None else row["lang"], name)
            leaves[leaf].append((row, tokens))
            totals[leaf] += tokens
    budgets = mixing.leaf_budgets(totals, int(share * sum(totals.values())), MIXTURE, epochs)
    for leaf, members in leaves.items():
        left, epoch = budgets.get(leaf, 0), 0
        while left > 0:
            keyed = []
            for row, tokens in members:
                name = "null" if row["doc_id"] is None else str(row["doc_id"])
                crc = np.uint32(zlib.crc32(row["text"].encode()))
                keyed.append((hashlib.md5(f"{seed}:{epoch}:{name}".encode()).hexdigest(), name, tokens, int(crc), row))
            for _, _, tokens, _, row in sorted(keyed, key=lambda k: k[:4]):
                left -= tokens
                if left < 0:
                    break
                yield row, epoch
            epoch += 1


@pytest.mark.parametrize(("share", "epochs"), [(0.35, 1), (0.9, 1), (2.2, 4)])
def test_the_mixture_takes_each_leafs_prefix(spark, share, epochs):
    rng = np.random.default_rng(4)
    plain = [
        (None if i % 40 == 0 else i // 2, " ".join("w" * int(n) for n in rng.integers(1, 5, rng.integers(0, 12))), ["en", "de", None, "xx"][i % 4], f"src{i % 9}" if i % 13 else None, i)
        for i in range(300)
    ]
    docs = spark.createDataFrame(plain, "doc_id long, text string, lang string, source string, tokens int")
    with_domain = docs.withColumn("domain", mixing.source_domain(F.coalesce("source", F.lit("null")))).collect()
    want = sorted((r["doc_id"] or -1, r["lang"] or "null", e, len(r["text"].split())) for r, e in _mixed(with_domain, share, epochs, mixing.SEED))
    got = mixing.mix(docs, MIXTURE, share, epochs).collect()
    assert want and sorted((r.doc_id or -1, r.lang, r.epoch, r.n_tokens) for r in got) == want


def test_a_whole_run_against_plain_loops(spark, tmp_path):
    """Nulls, empty texts, ties, repeated ids, near copies and columns of odd names through all stages."""
    rng = np.random.default_rng(9)
    words = [f"word{i}" for i in range(400)]
    texts = [" ".join(rng.choice(words, 60)) + "." for _ in range(30)]
    texts += [t.replace("word1", "other", 1) for t in texts[:6]] + texts[6:12] + [None, "", " \n", "Short one.", texts[0]]
    rows = [(i if i % 7 else i // 2, t, ["en", "de", None][i % 3], f"src{i % 5}", i, f"x{i}") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, gone_id int, `my col-x` string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(r[0], int(r[4] % 2), 0) for r in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "exact dedup", "near-duplicate dedup", "mixing", "byte-level BPE"]

    # Quality: what the operator itself predicts, told by the rows that stay. It carries every column.
    good = quality.keep_good(docs, quality.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")))
    assert good.columns == docs.columns
    # The stages after it work on all rows here, so that they meet every case.
    unique = stages["exact dedup"](spark, docs, str(tmp_path))
    best = {}
    for r in sorted(rows, key=lambda r: r[0]):
        best[r[1] or ""] = r[0]
    held = unique.collect()
    assert unique.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in held) == sorted((i, t) for t, i in best.items())

    near = stages["near-duplicate dedup"](spark, unique, str(tmp_path))
    sets = [set(near_dedup.shingles((r.text or "").encode()).tolist()) for r in held]
    group = list(range(len(held)))
    for a in range(len(held)):
        for b in range(a):
            if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    stays = near.collect()
    assert near.columns == docs.columns and len(stays) == len(set(group)) < len(held)
    left = {(r.doc_id, r.text) for r in stays}
    for g in set(group):
        members = [held[i] for i in range(len(held)) if group[i] == g]
        kept = [r for r in members if (r.doc_id, r.text) in left]
        assert len(kept) == 1 and kept[0].doc_id == min(r.doc_id for r in members)

    mixed = stages["mixing"](spark, near, str(tmp_path))
    with_domain = near.withColumn("domain", mixing.source_domain(F.coalesce("source", F.lit("null")))).collect()
    want = [r["gone_id"] for r, _ in _mixed(with_domain, corpus_pipeline.MIXTURE_SHARE, 1, mixing.SEED)]
    assert mixed.columns == docs.columns
    chosen = mixed.collect()
    assert sorted(r.gone_id for r in chosen) == sorted(want)

    encoder = bpe.text_encoder(bpe.read_ranks(public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN)
    encoded = {(r.doc_id, r.ids_sha256): r for r in stages["byte-level BPE"](spark, mixed, str(tmp_path)).collect()}
    assert len(encoded) == len(chosen)
    for r, ids in zip(chosen, encoder.encode_many([r.text for r in chosen]), strict=True):
        out = encoded[r.doc_id, hashlib.sha256(ids).hexdigest()]
        assert out.n_tokens == len(ids) // 4 and out.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()

    # The whole chain runs as one and encodes nothing that the quality stage let go.
    good_ids = {r.doc_id for r in good.collect()}
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} <= good_ids
