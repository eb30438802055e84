"""Ranked search, the Merkle manifest and the secret ledger against plain loops."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterhawk.llm import merkle, pair_search, secrets
from meterhawk.llm.common import Scratch

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, queries, k):
    """Scores by the formula, every document against every query."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, b) for i, b in bags if b]
    n, total = len(held), sum(b.total() for _, b in held)
    df = Counter(w for _, b in held for w in b)
    weight = {w: math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for w, f in df.items()}
    asked = {}
    for q, text in queries:
        asked.setdefault(q, []).extend(terms(text))
    out = []
    for q, words in asked.items():
        found = []
        for i, bag in held:
            m = 100 - 25 + (25 * bag.total() * n) // total
            score = sum(weight[w] * ((1_000_000_000 * bag[w]) // (1000 * bag[w] + 12 * m)) for w in words if bag[w])
            if score > 0:
                found.append((-score, i is not None, i or 0))
        out += [(q, r + 1, i if known else None, -s) for r, (s, known, i) in enumerate(sorted(found)[:k])]
    return Counter(out)


@pytest.mark.parametrize(("shard_bytes", "shard_docs", "query_bytes"), [(pair_search.SHARD_BYTES, 4096, pair_search.QUERY_BYTES), (700, 7, 600), (5_000, 300, 2_000)])
def test_ranked_search_is_exact(spark, shard_bytes, shard_docs, query_bytes):
    rng = np.random.default_rng(3)
    words = [f"W{n}é" if n % 5 == 0 else f"w{n}" for n in range(400)]
    texts = [" ".join(words[int(w)] for w in rng.zipf(1.25, int(rng.integers(1, 60))) if w < 400) for _ in range(500)]
    docs = [*enumerate(texts), (7, texts[7]), (7, "other text of a repeated id w1 w2"), (None, texts[9]), (600, None), (601, ""), (602, " \x7f-\n"), (603, "w1 " * 30_000)]
    queries = [(n, f"{texts[n]} {texts[n + 1]} w1 w1") for n in range(0, 120, 10)] + [(None, "w1, W2!"), (5, None), (6, "unheard of words"), (10, "w3 w4")]
    table = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, query_id string").repartition(3)
    got = pair_search.top_documents(table, spark.createDataFrame(queries, "query_id long, text string"), 20, shard_bytes, shard_docs, query_bytes)
    assert Counter(map(tuple, got.collect())) == ranked(docs, queries, 20)
    assert pair_search.top_documents(table.limit(0), spark.createDataFrame(queries, "query_id long, text string")).count() == 0
    assert pair_search.top_documents(table, spark.createDataFrame([], "query_id long, text string")).count() == 0


def shard_of(texts, queries):
    vocabulary, coded = {}, []
    for t in texts:
        coded.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in pair_search.terms_of(t.encode())], np.int64))
    row = pair_search.build_shard(list(range(len(texts))), coded, vocabulary).to_pylist()[0]
    corpus = pair_search.Corpus(row["holding"], row["length"])
    asked = [(n, sorted(Counter(pair_search.terms_of(q.encode())).items())) for n, q in enumerate(queries)]
    words = {w: n for n, w in enumerate(sorted({w for _, terms in asked for w, _ in terms}))}
    frequencies = np.array([sum(w in set(pair_search.terms_of(t.encode())) for t in texts) for w in words])
    plan = pair_search._plan(asked, corpus, words, frequencies)
    return pair_search.Shard(pair_search.ready_shard(row, *plan[:4]), len(words), len(plan[3])), plan[4]


def test_pair_bounds_hold_and_tighten():
    rng = np.random.default_rng(5)
    # Even and odd common words seldom meet, so their joint maxima stay below the sum of their own.
    texts = [" ".join([*(f"c{int(x) * 2 + i % 2}" for x in rng.integers(0, 6, 12)), f"r{int(rng.integers(0, 90))}"] * int(rng.integers(1, 4))) for i in range(900)]
    shard, queries = shard_of(texts, ["c0 c1 c2 c3 c4 c5 r7 c0", "c1 c2 c3 r8 r9", "c5 c4 r1"])
    for query in queries:
        documents, scores, _ = shard.search(query, 1)
        own = shard.peaks[shard.place[query.codes]] * (query.times * query.weights)[:, None]
        _, single = shard.units(query, own, paired=False)
        _, paired = shard.units(query, own)
        highest = np.zeros(shard.blocks, np.int64)
        np.maximum.at(highest, documents // pair_search.BLOCK_DOCS, scores)
        assert (paired.sum(axis=0) >= highest).all() and (paired.sum(axis=0) <= single.sum(axis=0)).all()
        assert paired.sum() < single.sum()
        need = int(np.sort(scores)[-20])
        for how in (True, False):
            some, own_scores, read = shard.search(query, need, paired=how)
            assert sorted(zip(some, own_scores)) == sorted((d, s) for d, s in zip(documents, scores) if s >= need)
        assert np.count_nonzero(paired.sum(axis=0) >= need) <= np.count_nonzero(single.sum(axis=0) >= need)
        assert shard.search(query, need)[2] < shard.search(query, 1)[2]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_manifest(rows):
    """By whole trees in memory; rows are (doc_id, source, lang, n_chars, text)."""

    def leaf(row):
        return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])

    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: sorted(trees[x], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in order}
    built = {x: plain_tree([leaf(r) for r in trees[x]]) for x in order}
    top = plain_tree([built[x][-1][0] for x in order])
    out = Counter()
    for rank, x in enumerate(order):
        for at, row in enumerate(trees[x]):
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None
            folded = leaf((*row[:3], row[3] + 1, row[4])) if changed else leaf(row)
            proof = []
            for levels, place in ((built[x], at), (top, rank)):
                for level in levels[:-1]:
                    other = level[place ^ 1] if place ^ 1 < len(level) else ""
                    folded = digest(other, folded) if place & 1 else digest(folded, other)
                    proof.append(other)
                    place >>= 1
            out[row[0], leaf(row), built[x][-1][0], top[-1][0], digest(*proof), folded, folded == top[-1][0]] += 1
    return out


@pytest.mark.parametrize("step", [1, 2, 3, 8])
def test_merkle_manifest(spark, step):
    rows = [(i, f"s{i % 3}", ["en", "en", "en", "fr", "é", "z"][i % 6], i if i % 11 else None, f"text {i} ü" if i % 13 else None) for i in range(170)]
    rows += [(None, None, None, None, None)] * 3 + [(5, "s", "en", 1, "a")] * 40 + [(5, "s", "en", 1, "b"), (9, "s", "", 3, ""), (1000, None, "only", None, "x" * 200_000)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, tree string").repartition(5)
    leaves = merkle.document_leaves(table, F.crc32(F.col("doc_id").cast("string")) % 7 == 0)
    got = merkle.manifest(leaves, step)
    assert got.columns == ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.collect())) == plain_manifest(rows)


def test_merkle_small_trees(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    never = F.lit(False)
    assert merkle.manifest(merkle.document_leaves(spark.createDataFrame([], schema), never)).count() == 0
    for n in (1, 2, 3, 4, 5):
        rows = [(2_000 + i, "s", "en", i, "t") for i in range(n)]
        got = merkle.manifest(merkle.document_leaves(spark.createDataFrame(rows, schema), F.crc32(F.col("doc_id").cast("string")) % 7 == 0), 2)
        assert Counter(map(tuple, got.collect())) == plain_manifest(rows)


def test_only_every_few_levels_are_written(spark):
    leaves = spark.range(300).select(F.lit("=en").alias("tree"), "id", F.sha2(F.col("id").cast("string"), 256).alias("digest"), F.lit(None).cast("string").alias("altered"))
    levels = merkle.build(leaves, Scratch(spark, "t"), 3)
    # 300 leaves in runs of 8: levels 0, 3 and 6 are written, of 10.
    assert [level.count() for level in levels] == [38, 5, 1]
    tree = plain_tree([hashlib.sha256(str(i).encode()).hexdigest() for i in range(300)])
    assert levels[-1].first()["top"] == tree[-1][0]
    assert [m["digest"] for r in levels[1].orderBy("run").collect() for m in r["members"]] == tree[3]


BASE = {
    "assign": (re.compile("""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile("[0-9a-f]+"), 0, 32),
}
EXTRA = {"private_key": (re.compile("-----BEGIN [A-Z ]*PRIVATE KEY-----"), 0, 1), "forge": (re.compile("gh[pousr]_[A-Za-z0-9]{36,}"), 0, 1)}


def plain_spans(text, kinds):
    found = []
    for place, (kind, (pattern, group, least)) in enumerate(kinds.items()):
        found += [(m.start(), place, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return [(s, kind) for _, _, s in sorted(found) for kind in [s.split(":")[0]]]


HEX = "0123456789abcdef" * 2
SECRETS = [
    (1, f"日本 PassWord = 'abcdefgh' then token:short and é🙂 {HEX}"), (2, f"🙂 token = \"{HEX}\"; AKIA0123456789AB AKIA012345678 AKIAAKIA00"),
    (3, None), (4, ""), (5, "password=token:abcdefgh123 secretsecret==abcdefgh"), (6, f"🙂 token = \"{HEX}\"; AKIA0123456789AB AKIA012345678 AKIAAKIA00"),
    (6, f"{HEX}{HEX}g{HEX[:-1]}"), (None, "api_key: 12345678\napikey\t=\t12345678"), (7, "-----BEGIN RSA PRIVATE KEY-----\nghp_" + "a" * 36), (8, "x" * 300_000 + " secret=abcdefgh " * 3_000),
    (9, "ſecret=abcdefgh toKen=abcdefgh"), (10, "Passwd\"   :   'a/b+c=d.e_f-g'"),
]


def test_secret_spans(spark):
    table = spark.createDataFrame([(i, t, "x") for i, t in SECRETS], "doc_id long, text string, blob string")
    paths, _ = secrets.find_secrets(table)
    got = Counter(map(tuple, secrets.digest(paths).collect()))
    want = Counter()
    for i, t in SECRETS:
        every, base = plain_spans(t, BASE | EXTRA), plain_spans(t, BASE)
        counts = Counter(kind for _, kind in every)
        want[i, counts["assign"], counts["access"], counts["hex"], hashlib.sha256(",".join(s for s, _ in base).encode()).hexdigest(), ",".join(s for s, _ in every)] += 1
    assert got == want
    assert secrets.find_secrets(table.limit(0))[0].count() == 0


def test_ledger_scans_only_what_it_has_not_seen(spark):
    table = spark.createDataFrame(SECRETS, "doc_id long, text string")
    blobs = len({t or "" for _, t in SECRETS})
    paths, first = secrets.find_secrets(table)
    assert first.count() == blobs and first.select(F.explode("scans")).count() == blobs * len(secrets.RULES)
    again, none = secrets.find_secrets(table, ledger=first)
    assert none.count() == 0
    assert Counter(map(str, again.collect())) == Counter(map(str, paths.collect()))
    more = table.unionByName(spark.createDataFrame([(50, "new text secret=abcdefgh"), (51, SECRETS[0][1])], "doc_id long, text string"))
    found, added = secrets.find_secrets(more, ledger=first)
    assert added.count() == 1
    assert {r.doc_id: r.spans for r in found.collect() if r.doc_id in (1, 51)}[51] == {r.doc_id: r.spans for r in paths.collect()}[1]
    # A new version of one rule is run over every blob, the others over none, and the old version's findings are gone.
    changed = tuple(secrets.Rule("access", "AKIA[A-Z0-9]+", least=10, version=2) if r.kind == "access" else r for r in secrets.RULES)
    renewed, scans = secrets.find_secrets(table, changed, ledger=first)
    assert {(s["kind"], s["version"]) for r in scans.collect() for s in r["scans"]} == {("access", 2)} and scans.count() == blobs
    wider = BASE | EXTRA | {"access": (BASE["access"][0], 0, 10)}
    for (i, t), want in zip(SECRETS, [plain_spans(t, wider) for _, t in SECRETS]):
        if i not in (6, None):
            (row,) = [r for r in renewed.collect() if r.doc_id == i]
            assert [f"{s['kind']}:{s['start']}:{s['end']}" for s in row.spans] == [s for s, _ in want]
