"""Many queries held against blocks of documents find what each of them finds by itself, in far less time."""

import time
from collections import Counter

import numpy as np
import pytest

from meterhawk.llm import search
from tests.llm.test_operators import _ranked


def _texts(rng, count, words):
    """Words of two tongues by rank, a few names met once, and lengths from none to long."""
    for i in range(count):
        size = int(rng.choice([0, 1, 5, words, words, 4 * words]))
        yield " ".join([f"{'ab'[i % 2]}{int(w)}" for w in rng.zipf(1.2, size) if w < 20_000] + [f"name{i // 3}"] * (i % 4 == 0))


def _shards(texts, size, known=lambda n: True):
    bags = [search.terms_of(t.encode()) for t in texts]
    return [
        search.build_shard([n // 2 if known(n) else None for n in range(a, min(a + size, len(bags)))], bags[a : a + size]) for a in range(0, len(bags), size)
    ]


def _asked(texts, seed):
    bags = [search.terms_of(t.encode()) for t in texts]
    vocabulary, codes = np.unique(np.concatenate([t for t, _ in bags]), return_inverse=True)
    gains = np.random.default_rng(seed).uniform(0.01, 9, len(vocabulary))[codes] * np.concatenate([c for _, c in bags])
    return vocabulary, 60.0, np.append(0, np.cumsum([len(t) for t, _ in bags])), codes.astype(np.int32), gains


def _at_once(shards, asked, k, floors=None):
    names = np.arange(len(asked[2]) - 1)
    vocabulary, mean_length, *terms = asked
    _, blocks, rest = search._batch(vocabulary, names, *terms, mean_length)
    return search._find_many(shards, blocks, *rest, k, np.zeros(len(names)) if floors is None else floors)


def _lists(found):
    lists = {}
    for numbers, scores, known, ids in found:
        for n, s, y, i in zip(numbers.tolist(), scores.tolist(), known.tolist(), ids.tolist(), strict=True):
            lists.setdefault(n, []).append((s, y, i))
    return lists


@pytest.mark.parametrize(("cells", "queries", "terms", "entries", "share"), [(6 << 20, 8_192, 1_024, 24_576, 1e-3), (3_000, 130, 7, 50, 0.01), (1, 40, 1, 1, 0), (900, 1_000, 64, 10, 1)])
def test_blocks_find_what_single_queries_find(monkeypatch, cells, queries, terms, entries, share):
    for name, value in (("BLOCK_CELLS", cells), ("BLOCK_QUERIES", queries), ("BLOCK_TERMS", terms), ("LIST_ENTRIES", entries), ("_DENSE_SHARE", share)):
        monkeypatch.setattr(search, name, value)
    rng = np.random.default_rng(3)
    texts = [*_texts(rng, 200, 30), *["a1 a2 b1 name7"] * 30, *["a3 " * 70_000] * 2]
    shards = _shards(texts + texts[:60], 90, known=lambda n: n % 17)
    asked = _asked([*texts[:90], *texts[-5:], *texts[:20], "nowhere"], 4)
    for k in (1, 7, 400):
        one_by_one, at_once = _lists(search._find_few(shards, *asked, k)), _lists(_at_once(shards, asked, k))
        # The very same numbers, so that ties fall alike too.
        assert one_by_one == at_once and len(at_once) > 60
        # Floors take nothing that reaches them.
        floors = np.array([one_by_one[n][len(one_by_one[n]) // 2][0] if n in one_by_one else 0.0 for n in range(len(asked[2]) - 1)])
        above = _lists(_at_once(shards, asked, k, floors))
        assert above == {n: [x for x in found if x[0] >= floors[n]] for n, found in one_by_one.items()}


def test_blocks_take_less_work_than_single_queries():
    """One at a time, long queries read nearly every posting of theirs."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{int(w)}" for w in np.minimum(rng.zipf(1.15, 300), 30_000)) for _ in range(2_400)]
    shards, asked = _shards(texts, 1_200), _asked(texts[:1_200], 6)
    took = []
    for find in (lambda: search._find_few(shards, *asked, 10), lambda: _at_once(shards, asked, 10)):
        began = time.thread_time()
        took.append((_lists(find()), time.thread_time() - began))
    assert took[0][0] == took[1][0]
    assert 2 * took[1][1] < took[0][1]


def test_a_batch_of_many_queries_is_exact(spark):
    rng = np.random.default_rng(8)
    texts = list(_texts(rng, 260, 25))
    rows = [*enumerate(texts), *((600 + i, texts[i % 9]) for i in range(60)), (None, texts[0]), (None, texts[1]), (5, texts[5]), (300, None), (301, ""), (302, "a1 b2 " * 30_000)]
    asked = [*((i, texts[i]) for i in range(260)), (900, "a3"), (900, "a3 b4"), (901, None), (902, "nowhere"), (None, "a3"), (903, "a1 " * 5_000)]
    assert len({i for i, t in asked if i is not None and t}) > 2 * search.MANY
    docs, queries = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(asked, "query_id long, text string")
    want = sorted((q, rank, -1 if i is None else i, s) for q, rank, i, s in _ranked(rows, asked, 12))
    for shape in ((), (2_000, 300), (1 << 20, 50, 60_000)):
        mine = sorted((r.query_id, r.rank, -1 if r.doc_id is None else r.doc_id, r.score) for r in search.top_documents(docs, queries, 12, *shape).collect())
        assert [r[:3] for r in mine] == [r[:3] for r in want]
        assert np.allclose([r[3] for r in mine], [r[3] for r in want])


def test_the_leaders_of_queries_are_the_best_of_all_added():
    rng = np.random.default_rng(2)
    leaders, singles = search.Leaders(np.zeros(9), 4), [search.Best(4) for _ in range(9)]
    for size in (0, 3, 40, 1, 90):
        queries, scores = rng.integers(0, 8, size), rng.integers(1, 6, size).astype(float)
        known, ids = rng.integers(0, 2, size).astype(np.int8), rng.integers(0, 5, size)
        if size:
            leaders.add(queries, scores, known, ids)
        for n, single in enumerate(singles):
            single.add(scores[queries == n], known[queries == n], ids[queries == n])
        for n, single in enumerate(singles):
            assert leaders.found[n] == len(single.ids) and leaders.thresholds[n] == single.threshold
            for one, many in ((single.scores, leaders.scores), (single.ids, leaders.ids), (single.known, leaders.known)):
                assert one.tolist() == many[n, : len(one)].tolist()
    assert Counter(leaders.found.tolist())[0] == 1
