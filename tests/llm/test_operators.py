"""The operators against brute force on small tables with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import re
from array import array
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterhawk.llm import bpe, chat, components, exact_dedup, mixing, near_dedup, quality, search, sharding, token_counts, toxicity
from meterhawk.llm.common import Scratch

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
SCHEMA = "doc_id long, text string, lang string, source string, keep_id string"
LONG = " ".join(f"word{i % 997}" for i in range(20_000))
ROWS = [
    (1, "a b c d e f g", "en", "src1", "x"), (2, "a b c d e f g", "en", "src1", None), (2, "a b c d e f g", "en", "src2", None),
    (3, None, None, None, None), (4, "", "en", "src0", "y"), (5, " \t\n", "de", "src5", None), (None, "alone here", "en", "src1", None),
    (6, LONG, "en", "src1", None), (7, LONG + " tail", "en", "src1", None), (8, "A B C D E F G", "en", "src3", None), (9, "one", "fr", "odd", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_exact_copies_and_spilling(docs):
    for limit in (10, exact_dedup.TABLE_BYTES):
        got = exact_dedup.group_copies(docs, table_bytes=limit, chunk_bytes=limit).collect()
        groups = {}
        for doc_id, text, *_ in ROWS:
            groups.setdefault(text or "", []).append(doc_id)
        assert len(got) == len(ROWS) and sum(r.kept for r in got) == len(groups)
        ids = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in groups.items()}
        for r in got:
            members = ids[r.text_sha256]
            assert r.group_size == len(members)
            assert r.keep_id == max((m for m in members if m is not None), default=None)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.group_copies(docs.limit(0)).count() == 0


def test_near_copies(docs, spark):
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()}
    assert got[3, 0] == (3, True) and got[4, 0] == (4, True) and got[9, 1] == (9, True)
    assert got[1, 3] == (1, True) and got[2, 3] == (1, False) and got[8, 3] == (1, False)
    # The long text repeats 997 shingles; its longer sibling adds one.
    assert got[6, 997] == (6, True) and got[7, 998] == (6, False)
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0
    words = [f"w{i}" for i in range(60)]
    chain = [(i, " ".join(words[i : i + 40]), None, None, None) for i in range(12)]
    shared = [(100 + i, " ".join([*words[:30], *[f"x{i}y{j}" for j in range(12)]]), None, None, None) for i in range(20)]
    found = near_dedup.near_duplicates(spark.createDataFrame(chain + shared, SCHEMA)).collect()
    assert {r.component_id for r in found if r.doc_id < 100} == {0}
    assert all(r.kept for r in found if r.doc_id >= 100)


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 9), (9, 8), (20, 21), (30, 30)], "a long, b long")
    labels = components.star_labels(links, Scratch(spark, "t"))
    assert {(r.node, r.label) for r in labels.collect()} == {(2, 1), (3, 1), (8, 1), (9, 1), (21, 20)}


def test_sharding(docs, spark):
    rows = sharding.shard_rows(docs, 4).collect()
    counts = Counter(r.shard for r in rows)
    assert len(rows) == len(ROWS) and max(counts.values()) - min(counts.values()) <= 1
    for shard in counts:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(counts[shard]))
    assert sharding.shard_rows(docs.limit(0)).count() == 0
    for n in (1, 2, 7, 1000):
        moved = spark.range(n).withColumn("p", sharding.permute(F.col("id"), n)).withColumn("b", sharding.restore(F.col("p"), n))
        assert sorted(r.p for r in moved.collect()) == list(range(n)) and moved.where("b != id").count() == 0


def test_bpe_matches_tiktoken(docs):
    tiktoken = pytest.importorskip("tiktoken")
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(RANKS), special_tokens={})
    encoder = bpe.text_encoder(RANKS, public_tokenizers.PATTERN)
    for text in ["", " ", "it's  we're\n\nél über 日本🙂 1234", "a" * 500, LONG, "x'r", "\x00\x7f́"]:
        ids = encoder.encode(text)
        assert list(array("I", ids)) == own.encode_ordinary(text)
        assert bpe.decode(ids, encoder.vocabulary.tokens) == text.encode()
        assert encoder.append(text, ids, "e more") == (text + "e more", encoder.encode(text + "e more"))
    table = bpe.PrefixEncoder(encoder.vocabulary, b"understanding " * 40)
    computed = table.replace(30, 33, b"xyz")
    assert computed < 150 and table.last == bpe.PrefixEncoder(encoder.vocabulary, table.data).last
    rows = bpe.encode_and_decode(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(ROWS)
    counted = token_counts.document_tokens(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == Counter((r.doc_id, r.n_tokens) for r in counted)


def test_chat_round_trip(spark):
    said = "\\### Assistant: </turn> ok"
    rows = [(1, 0, "user", said), (1, 1, "assistant", said), (2, 0, "System", "x\\"), (2, 1, None, None), (2, 2, "a: b", "### </turn>\n"), (None, 0, "user", "hi")]
    done = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    turns = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in done.collect()}
    assert turns == {1: [("user", said), ("assistant", said)], 2: [("System", "x\\"), ("", ""), ("a: b", "### </turn>\n")], None: [("user", "hi")]}
    figures = {r.conv_id: r for r in chat.digest(done).collect()}
    assert figures[1].loss_chars == len(said) and figures[1].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert chat.format_conversations(done.limit(0).selectExpr("conv_id", "1L turn", "'' role", "'' text")).count() == 0


def test_mixing(docs, spark):
    shares = mixing.share_out(100, [("a", 1.0, 10), ("b", 1.0, 1000), ("c", 2.0, 1000), ("d", 0.0, 1000)])
    assert shares == {"a": 10, "b": 30, "c": 60, "d": 0}
    leaves = {("x", "en", "s"): 50, ("x", "de", "s"): 1000, ("y", "en", "s"): 1000}
    budgets = mixing.leaf_budgets(leaves, 400, mixing.Mixture(), 1)
    assert budgets == {("x", "en", "s"): 50, ("x", "de", "s"): 150, ("y", "en", "s"): 200}
    taken = mixing.mix(docs, share=0.5, epochs=1).collect()
    total = sum(len(re.findall(mixing.WORD, t or "")) for _, t, *_ in ROWS)
    assert 0 < sum(r.n_tokens for r in taken) <= total // 2 + 1
    every = mixing.select_rows(docs, share=1.0, epochs=1)
    assert every.columns == docs.columns and every.count() == sum(bool((t or "").strip()) for _, t, *_ in ROWS)
    assert mixing.mix(docs.limit(0)).count() == 0


def _ranked(rows, asked, k):
    """Every document scored by a plain loop: [(query, rank, doc, score)]; a null id goes before all others."""
    bags = [(i, Counter((t or "").split())) for i, t in rows]
    n, mean = len(bags), sum(b.total() for _, b in bags) / max(len(bags), 1)
    held = Counter(w for _, b in bags for w in b)
    wanted = {}
    for query, text in asked:
        if query is not None:
            wanted.setdefault(query, Counter()).update((text or "").split())
    for query, bag in wanted.items():
        scored = []
        for i, b in bags:
            parts = [q * np.log1p((n - held[w] + 0.5) / (held[w] + 0.5)) * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * b.total() / mean)) for w, q in bag.items() if b[w]]
            if parts:
                scored.append((-round(sum(parts), 9), i is not None, i or 0, i))
        yield from ((query, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1))


@pytest.mark.parametrize(("shard_bytes", "shard_docs", "batch_bytes"), [(search.SHARD_BYTES, search.SHARD_DOCS, search.BATCH_BYTES), (2_000, 300, 1_000), (1 << 20, 7, 4_000)])
def test_search_is_exact(spark, shard_bytes, shard_docs, batch_bytes):
    rng = np.random.default_rng(0)
    texts = [" ".join(f"t{int(w)}" for w in rng.zipf(1.3, 40) if w < 500) for _ in range(300)]
    rows = [*enumerate(texts), *((600 + i, texts[i % 4]) for i in range(40)), (None, texts[0]), (None, texts[1]), (5, texts[5]), (300, None), (301, ""), (302, "t1 t2 " * 30_000)]
    asked = [*((i, texts[i]) for i in range(0, 300, 30)), (900, "t3"), (900, "t3 t4"), (901, None), (902, "nowhere"), (None, "t3"), (903, "t1 " * 5_000)]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, score long")
    queries = spark.createDataFrame([(i, t, 1) for i, t in asked], "query_id long, text string, rank int")
    got = search.top_documents(docs, queries, 12, shard_bytes, shard_docs, batch_bytes)
    mine = sorted((r.query_id, r.rank, r.doc_id, r.score) for r in got.withColumn("doc_id", F.coalesce("doc_id", F.lit(-1))).collect())
    want = sorted((q, rank, -1 if i is None else i, s) for q, rank, i, s in _ranked(rows, asked, 12))
    assert [r[:3] for r in mine] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in mine], [r[3] for r in want])
    assert search.top_documents(docs.limit(0), queries).count() == 0
    assert search.top_documents(docs, queries.limit(0)).count() == 0


def test_search_passes_over_ranges():
    rng = np.random.default_rng(1)
    texts = [" ".join(f"{'abcd'[i % 4]}{int(w)}" for w in rng.zipf(1.5, 60) if w < 300) for i in range(2_000)]
    bags = [search.terms_of(t.encode()) for t in texts]
    vocabulary = np.unique(np.concatenate([t for t, _ in bags]))
    shard = search.Shard(search.build_shard(list(range(2_000)), bags), vocabulary, 55.0, range_docs=4)
    codes, gains = np.searchsorted(vocabulary, bags[0][0]), bags[0][1] * 2.0
    every, few = search.Best(2_000), search.Best(5)
    whole, read = shard.search(codes, gains, every), shard.search(codes, gains, few)
    assert 0 < read < whole
    assert few.ids.tolist() == every.ids[:5].tolist() and few.scores.tolist() == every.scores[:5].tolist()
    # A threshold out of reach passes over the whole shard.
    few.scores = few.scores + every.scores[0] * 100
    assert shard.search(codes, gains, few) == 0


def test_classifiers(spark):
    good = [(i, f"the calm text number {i} goes on and on. it says little more.", None, None, None) for i in range(80)]
    bad = [(100 + i, f"BUY!! NOW!! {i}!! you idiot and moron. " * 4, None, None, None) for i in range(80)]
    docs = spark.createDataFrame([*good, *bad, *ROWS], SCHEMA)
    labels = spark.createDataFrame([(i, int(i < 100), int(i >= 100)) for i, *_ in good + bad], "doc_id long, quality int, toxic int")
    for module, wanted in ((quality, 1), (toxicity, 0)):
        rows = module.score_documents(docs, module.fit(docs, labels)).collect()
        assert len(rows) == 160 + len(ROWS) and all(0 <= r.score <= 1 for r in rows)
        scores = {r.doc_id: r.predicted for r in rows if r.doc_id is not None and r.held_out}
        assert all(scores[i] == (wanted if i < 100 else 1 - wanted) for i in [*range(10, 80), *range(100, 180)] if i in scores)
        flat = module.score_documents(docs, module.fit(docs, labels.limit(0))).select("score").distinct().collect()
        assert [r.score for r in flat] == [0.5]
    kept = quality.keep_good(docs, quality.fit(docs, labels))
    assert kept.columns == docs.columns
