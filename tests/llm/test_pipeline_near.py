"""The pipeline's near-duplicate stage against all-pairs Jaccard."""

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from meterhawk.llm import near_dedup  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string"


def _pair(name, changed):
    """Two texts of 100 words whose last ``changed`` words differ: (96 - changed) / (96 + changed) of the shingles are shared."""
    words = [f"{name}{i}" for i in range(100)]
    return " ".join(words), " ".join(words[: 100 - changed] + [f"{name}x{i}" for i in range(changed)])


def test_copies_from_four_fifths_are_dropped(spark):
    rows = []
    for at in range(20):
        for changed in (9, 10, 12):  # 0.829, 0.811 and 0.778
            rows += [(len(rows) + k, text, "en", "s") for k, text in enumerate(_pair(f"n{at}c{changed}w", changed))]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    sets = {i: set(near_dedup.shingles(text.encode()).tolist()) for i, text, *_ in rows}
    wanted = {i for i in sets if not any(5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) for j in range(i))}
    assert kept == wanted and len(wanted) == 80


def test_bands_follow_the_threshold():
    assert near_dedup.band_rows((85, 100)) == 6 and near_dedup.band_rows((80, 100)) == 4


def test_rows_that_repeat_an_id_are_told_apart_by_their_text(spark):
    copy, alone, other = _pair("a", 5)[0], *_pair("b", 60)
    rows = [
        (1, copy, "en", "s"), (2, copy.upper(), "en", "s"), (2, alone, "en", "s"),  # the second id leads a group of its own
        (3, other, "en", "x"), (3, other, "en", "y"), (3, other.upper(), "en", "s"), (3, "", "en", "s"), (None, copy, "en", "s"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = near_dedup.keep_one(docs)
    found = sorted((r.doc_id or 0, r.text.lower()) for r in kept.collect())
    assert kept.columns == docs.columns
    assert found == sorted([(1, copy), (2, alone), (3, other.lower()), (3, ""), (0, copy)])


def test_unrelated_texts_under_repeated_ids_all_stay(spark):
    texts = [_pair(n, 60)[0] for n in ("p", "q", "r")]
    docs = spark.createDataFrame([(2, texts[0], "en", "s"), (2, texts[1], "en", "s"), (1, texts[2], "en", "s")], SCHEMA)
    assert sorted(r.text for r in near_dedup.keep_one(docs).collect()) == sorted(texts)
    rows = near_dedup.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in rows) == [(1, 1, True), (2, 2, True), (2, 2, True)]


@pytest.mark.parametrize("bucket", [4, 256])
def test_crowds_against_all_pairs(spark, monkeypatch, bucket):
    """At the contract's 0.85 and with buckets of several blocks: a crowd around a passage, chains, copies and repeated ids."""
    monkeypatch.setattr(near_dedup, "BLOCK", bucket)
    import numpy as np

    rng = np.random.default_rng(bucket)
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join([*passage, *(f"v{int(w)}" for w in rng.integers(0, 6, 6 + i % 3))]), "en", "s") for i in range(70)]
    chain = [f"c{i}" for i in range(80)]
    rows += [(100 + i, " ".join(chain[i : i + 60]), "en", "s") for i in range(15)]
    rows += [(100, " ".join(chain[7:67]), "en", "s"), (3, "an unrelated text under an id that is used", "en", "s"), (3, rows[3][1], "en", "s")]
    sets = [frozenset(near_dedup.shingles(t.encode()).tolist()) for _, t, *_ in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {g: min(rows[k][0] for k in range(len(rows)) if group[k] == g) for g in group}
    want = sorted((rows[k][0], len(sets[k]), least[group[k]]) for k in range(len(rows)))
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == want


def test_columns_of_any_name_are_carried(spark):
    from meterhawk.llm import exact_dedup, quality

    names = ["id", "row", "gone_id", "kept_hash", "my col-x", "text_hash", "node", "group", "first", "score"]
    copy, other = _pair("a", 5)[0], _pair("b", 60)[0]
    rows = [(1, copy, *"abcdefghij"), (2, copy.upper(), *"klmnopqrst"), (2, other, *"ABCDEFGHIJ"), (2, other, *"ABCDEFGHIJ"), (5, None, *[None] * 10)]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, schema)
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    assert sorted(map(str, kept.collect())) == sorted(map(str, [docs.collect()[i] for i in (0, 2, 4)]))
    whole = exact_dedup.keep_one(docs)
    assert whole.columns == docs.columns and whole.count() == 4
    model = quality.fit(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"))
    good = quality.keep_good(docs, model, good=0.0)
    assert good.dtypes == docs.dtypes and good.count() == 5
