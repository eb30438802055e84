"""Exact ranked search by MaxScore with bounds of term pairs.

Documents are cut, where they lie, into shards closed by bytes of text or by documents, whichever comes first; a shard is one row of
the index: its dictionary and postings. No text is shuffled. Once the corpus's figures are known, every posting's impact, and each
term's greatest impact in each block of documents, are added. For pairs of common terms that a query holds
together, intersection lists are added: per block the greatest joint impact of a document that holds both.

A query covers its terms with pairs and single terms. A pair's bound in a block is the greatest of its joint maximum and
either term's own maximum, which is at most the sum of the two that MaxScore would use; of the pairs at hand those that
save most are taken, each term at most once. Summing up the bounds from the smallest gives, per block, the units that alone
cannot reach the k-th best score known. Blocks whose whole sum falls short are skipped, candidates come
from the other units' postings only, and the rest is looked up for candidates that can still reach it. Scores and
bounds are whole numbers, so nothing is lost by rounding and equal scores stay comparable. A task keeps the k best of the
shards it has seen; the tasks' lists are merged.

Score: a document's sum, over the query's terms with repeats, of ``w * ((10**9 * tf) // (1000 * tf + 12 * m))``, with ``w =
floor(1000 * ln((2N + 2) / (2df + 1)))`` and ``m = 75 + (25 * n * N) // L``. N counts documents with a term, L their terms, n one document's.

Queries run in batches of bounded bytes. Defined cases: rows of one query id, or of none, are one query holding all their
terms; a query without a known term finds nothing; a text without terms is found by nothing and is not counted; a null
document id comes before all others among equal scores; repeated rows are separate documents; an empty
table gives an empty result; other columns are ignored. A document longer than a shard is a shard of its own.
"""

from __future__ import annotations

import functools
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterhawk.llm.common import Scratch

TOP = 20
SHARD_BYTES = 3 << 20
SHARD_DOCS = 4096
BLOCK_DOCS = 64
QUERY_BYTES = 8 << 20
# A term is common if one document in so many holds it; in its query it is paired with the next ones by frequency.
COMMON = 50
REACH = 4
MERGE_PARTS = 64
_PAIRS_AT_ONCE = 64

# Fixed value: bytes that are part of a term; A to Z become lower case.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

# A shard has at most SHARD_DOCS documents and, as every text is shorter than 2 GB, fewer than 2 ** 31 postings.
_INDEX = {"ids": np.int64, "known": np.int8, "lengths": np.int32, "starts": np.int32, "docs": np.uint16, "times": np.int32}
_INDEX_SQL = "holding bigint, length bigint, words binary, " + ", ".join(f"{c} binary" for c in _INDEX)
_READY = {"ids": np.int64, "known": np.int8, "codes": np.int32, "starts": np.int32, "docs": np.uint16, "impacts": np.int32, "peaks": np.int32, "pairs": np.int32, "joint": np.int64}
_READY_SQL = ", ".join(f"{c} binary" for c in _READY)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def _unpack(row: dict, kinds: dict) -> dict[str, np.ndarray]:
    return {name: np.frombuffer(row[name], kind) for name, kind in kinds.items()}


def _row(values: dict, kinds: dict, **more) -> pa.RecordBatch:
    packed = {name: [np.ascontiguousarray(values[name], kind).tobytes()] for name, kind in kinds.items()}
    types = {name: pa.binary() for name in kinds} | {name: pa.binary() if isinstance(v, bytes) else pa.int64() for name, v in more.items()}
    packed |= {name: [v] for name, v in more.items()}
    order = [*more, *kinds]
    return pa.RecordBatch.from_arrays([pa.array(packed[c], types[c]) for c in order], names=order)


def build_shard(ids: list[int | None], terms: list[np.ndarray], vocabulary: dict[bytes, int]) -> pa.RecordBatch:
    """Index row of documents given by the codes of their terms."""
    lengths = np.array([len(t) for t in terms], np.int64)
    docs = np.repeat(np.arange(len(terms), dtype=np.int64), lengths)
    codes = np.concatenate([np.empty(0, np.int64), *terms])
    postings, times = np.unique((codes << 32) | docs, return_counts=True)
    values = {
        "ids": [0 if i is None else i for i in ids],
        "known": [i is not None for i in ids],
        "lengths": lengths,
        "starts": np.searchsorted(postings, np.arange(len(vocabulary) + 1, dtype=np.int64) << 32),
        "docs": postings & 0xFFFFFFFF,
        "times": times,
    }
    return _row(values, _INDEX, holding=int(np.count_nonzero(lengths)), length=int(lengths.sum()), words=b" ".join(vocabulary))


def _index_task(shard_bytes: int, shard_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, terms, held, vocabulary = [], [], 0, None
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if vocabulary is None:
                    vocabulary = defaultdict()
                    vocabulary.default_factory = vocabulary.__len__
                words = terms_of(text)
                ids.append(doc_id)
                terms.append(np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words)))
                held += len(text)
                if held >= shard_bytes or len(ids) >= shard_docs:
                    yield build_shard(ids, terms, vocabulary)
                    ids, terms, held, vocabulary = [], [], 0, None
        if ids:
            yield build_shard(ids, terms, vocabulary)

    return run


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """The index rows of docs (doc_id, text): one per shard, of every term."""
    if not 0 < shard_docs <= SHARD_DOCS:
        raise ValueError(f"a shard has 1 to {SHARD_DOCS} documents")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(_index_task(shard_bytes, shard_docs), _INDEX_SQL)


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, and all their terms."""

    holding: int
    length: int

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.holding + 2) / (2 * df + 1)))

    def impacts(self, times: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        m = 75 + (25 * lengths * self.holding) // max(self.length, 1)
        return (1_000_000_000 * times) // (1000 * times + 12 * m)


@dataclass(frozen=True)
class Query:
    """Terms by their place in the batch's vocabulary, how often each occurs times its weight, and the pairs
    at hand: two places in ``codes`` and the pair's number in the batch."""

    number: int
    codes: np.ndarray
    times: np.ndarray
    weights: np.ndarray
    pairs: np.ndarray


def choose_pairs(codes: list[int], frequencies: np.ndarray, holding: int, common: int = COMMON, reach: int = REACH) -> list[tuple[int, int]]:
    """Pairs of a query's common terms, each with the next ``reach`` by frequency; by place in ``codes``."""
    often = sorted((i for i, c in enumerate(codes) if frequencies[c] * common >= holding), key=lambda i: (-frequencies[codes[i]], codes[i]))
    return [(a, b) for n, a in enumerate(often) for b in often[n + 1 : n + 1 + reach]]


def _spread(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, one range after the other, and the range each belongs to."""
    sizes = stops - starts
    of = np.repeat(np.arange(len(starts)), sizes)
    return np.arange(sizes.sum()) + np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes), of


def ready_shard(row: dict, corpus: Corpus, vocabulary: dict[bytes, int], weights: np.ndarray, pairs: np.ndarray) -> dict[str, np.ndarray]:
    """The part of a shard that a batch of queries needs: impacts, block maxima and pair lists."""
    index = _unpack(row, _INDEX)
    words = row["words"].split()
    met = [(i, vocabulary[w]) for i, w in enumerate(words) if w in vocabulary]
    at, codes = np.array([i for i, _ in met], np.int64), np.array([c for _, c in met], np.int32)
    postings, of = _spread(index["starts"][at], index["starts"][at + 1])
    docs = index["docs"][postings]
    impacts = corpus.impacts(index["times"][postings].astype(np.int64), index["lengths"][docs].astype(np.int64))
    blocks = -(-len(index["ids"]) // BLOCK_DOCS)
    peaks = np.zeros((len(codes), blocks), np.int64)
    np.maximum.at(peaks, (of, docs // BLOCK_DOCS), impacts)
    starts = np.concatenate(([0], np.cumsum(index["starts"][at + 1] - index["starts"][at])))
    place = np.full(len(weights), -1, np.int64)
    place[codes] = np.arange(len(codes))
    both = np.flatnonzero((place[pairs[:, 0]] >= 0) & (place[pairs[:, 1]] >= 0))
    joint = np.zeros((len(both), blocks), np.int64)
    for n in range(0, len(both), _PAIRS_AT_ONCE):
        some = place[pairs[both[n : n + _PAIRS_AT_ONCE]]]
        terms, spot = np.unique(some, return_inverse=True)
        spot = spot.reshape(some.shape)
        dense = np.zeros((len(terms), blocks * BLOCK_DOCS), np.int64)
        for t, term in enumerate(terms):
            own = slice(starts[term], starts[term + 1])
            dense[t, docs[own]] = impacts[own]
        held = (dense[spot[:, 0]] > 0) & (dense[spot[:, 1]] > 0)
        gains = weights[codes[terms]][:, None] * dense
        sums = np.where(held, gains[spot[:, 0]] + gains[spot[:, 1]], 0)
        joint[n : n + len(some)] = sums.reshape(len(some), blocks, BLOCK_DOCS).max(axis=2)
    return {"ids": index["ids"], "known": index["known"], "codes": codes, "starts": starts, "docs": docs, "impacts": impacts, "peaks": peaks, "pairs": both, "joint": joint}


class Shard:
    """A shard as a batch of queries reads it."""

    def __init__(self, ready: dict[str, np.ndarray], terms: int, pairs: int):
        self.ids, self.known, self.starts, self.docs = ready["ids"], ready["known"], ready["starts"], ready["docs"]
        self.impacts = ready["impacts"].astype(np.int64)
        self.blocks = -(-len(self.ids) // BLOCK_DOCS)
        self.peaks = ready["peaks"].reshape(-1, self.blocks).astype(np.int64)
        self.joint = ready["joint"].reshape(-1, self.blocks)
        self.place = np.full(terms, -1, np.int64)
        self.place[ready["codes"]] = np.arange(len(ready["codes"]))
        self.pair_place = np.full(pairs, -1, np.int64)
        self.pair_place[ready["pairs"]] = np.arange(len(ready["pairs"]))

    def pair_bounds(self, query: Query, own: np.ndarray) -> np.ndarray:
        """Greatest joint score of each of the query's pairs in each block; ``own`` has that of each term."""
        a, b = query.pairs[:, 0], query.pairs[:, 1]
        at = self.pair_place[query.pairs[:, 2]]
        joint = np.zeros((len(at), self.blocks), np.int64)
        joint[at >= 0] = self.joint[at[at >= 0]]
        # A term that occurs more often in the query adds its surplus on its own.
        less = np.minimum(query.times[a], query.times[b])[:, None]
        more = np.where(query.times[a] >= query.times[b], a, b)
        surplus = own[more] - own[more] // query.times[more][:, None] * less
        return np.maximum(np.maximum(own[a], own[b]), np.where(joint > 0, less * joint + surplus, 0))

    def units(self, query: Query, own: np.ndarray, paired: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(unit of each term, bound of each unit and block), the smallest unit first."""
        left = np.ones(len(own), bool)
        chosen: list[tuple[tuple[int, ...], np.ndarray]] = []
        if paired and len(query.pairs):
            bounds = self.pair_bounds(query, own)
            saved = (own[query.pairs[:, 0]] + own[query.pairs[:, 1]] - bounds).sum(axis=1)
            for p in np.argsort(-saved, kind="stable"):
                a, b = query.pairs[p, :2]
                if saved[p] <= 0:
                    break
                if left[a] and left[b]:
                    left[a] = left[b] = False
                    chosen.append(((a, b), bounds[p]))
        chosen += [((t,), own[t]) for t in np.flatnonzero(left)]
        bounds = np.array([b for _, b in chosen])
        order = np.argsort(bounds.sum(axis=1), kind="stable")
        unit = np.empty(len(own), np.int64)
        for n, u in enumerate(order):
            unit[list(chosen[u][0])] = n
        return unit, bounds[order]

    def search(self, query: Query, need: int, paired: bool = True) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, postings read) of all documents that score at least ``need``, which is 1 or more."""
        at = self.place[query.codes]
        gains = query.times * query.weights
        own = np.where((at >= 0)[:, None], self.peaks[at] if len(self.peaks) else np.zeros((len(at), self.blocks), np.int64), 0) * gains[:, None]
        none = np.empty(0, np.int64)
        if not len(at) or not own.any():
            return none, none, 0
        unit, bounds = self.units(query, own, paired)
        reach = np.cumsum(bounds, axis=0)
        alive = reach[-1] >= need
        if not alive.any():
            return none, none, 0
        # In each block, the first unit with which those before it could reach the score.
        first = np.where(alive, np.argmax(reach >= need, axis=0), len(reach))
        scores = np.zeros(len(self.ids), np.int64)
        seen = 0
        terms = np.flatnonzero((at >= 0) & (unit >= first.min()))
        postings, of = _spread(self.starts[at[terms]], self.starts[at[terms] + 1])
        docs = self.docs[postings]
        open_ = unit[terms][of] >= first[docs // BLOCK_DOCS]
        seen += int(np.count_nonzero(open_))
        np.add.at(scores, docs[open_], gains[terms][of[open_]] * self.impacts[postings[open_]])
        candidates = np.flatnonzero(scores)
        block = candidates // BLOCK_DOCS
        by_unit = np.argsort(-unit, kind="stable")
        by_unit = by_unit[unit[by_unit] < first[alive].max()]
        wanted = np.zeros(len(scores), bool)
        last = -1
        for t in by_unit:
            u = unit[t]
            if u != last:
                last = u
                # Where unit u has been counted, the next unit that has not decides.
                stays = (first[block] <= u) | (scores[candidates] + reach[u][block] >= need)
                candidates, block = candidates[stays], block[stays]
                wanted[:] = False
                wanted[candidates[first[block] > u]] = True
            if at[t] < 0:
                continue
            own_postings = slice(self.starts[at[t]], self.starts[at[t] + 1])
            docs = self.docs[own_postings]
            hit = wanted[docs]
            seen += int(np.count_nonzero(hit))
            scores[docs[hit]] += gains[t] * self.impacts[own_postings][hit]
        best = candidates[scores[candidates] >= need]
        return best, scores[best], seen


def _ready_task(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, vocabulary, weights, pairs, _ = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                yield _row(ready_shard(row, corpus, vocabulary, weights, pairs), _READY)

    return run


class _Best:
    """The k best of a query so far: highest score, then null id, then least id."""

    def __init__(self, k: int):
        self.k, self.scores, self.known, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int8), np.empty(0, np.int64)

    @property
    def need(self) -> int:
        return max(1, int(self.scores[-1])) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, known: np.ndarray, ids: np.ndarray) -> None:
        scores, known, ids = np.concatenate((self.scores, scores)), np.concatenate((self.known, known)), np.concatenate((self.ids, ids))
        order = np.lexsort((ids, known, -scores))[: self.k]
        self.scores, self.known, self.ids = scores[order], known[order], ids[order]


def _search_task(sent, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, vocabulary, _, pairs, queries = sent.value
        best = {q.number: _Best(k) for q in queries}
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(_unpack(row, _READY), len(vocabulary), len(pairs))
                for query in queries:
                    held = best[query.number]
                    docs, scores, _ = shard.search(query, held.need)
                    if len(docs):
                        held.add(scores, shard.known[docs], shard.ids[docs])
        found = [(n, i if y else None, s) for n, b in best.items() for i, y, s in zip(b.ids.tolist(), b.known.tolist(), b.scores.tolist(), strict=True)]
        if found:
            columns = [pa.array([f[c] for f in found], pa.int64()) for c in range(3)]
            yield pa.RecordBatch.from_arrays(columns, names=["number", "doc_id", "score"])

    return run


def _frequency_task(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value
        held = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.diff(np.frombuffer(row["starts"], _INDEX["starts"]))
                for at, word in enumerate(row["words"].split()):
                    if word in vocabulary:
                        held[vocabulary[word]] += sizes[at]
        met = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(held[met])], names=["code", "held"])

    return run


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for query, text in zip(batch.column("query_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words = terms_of(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array([query] * len(words), pa.int64()), pa.array(words, pa.binary())], names=["query_id", "term"]
            )


def _plan(asked: list, corpus: Corpus, vocabulary: dict[bytes, int], frequencies: np.ndarray) -> tuple:
    """What the tasks of a batch are sent."""
    weights = np.array([corpus.weight(int(df)) for df in frequencies], np.int64)
    numbers: dict[tuple[int, int], int] = {}
    queries = []
    for number, (_, terms) in enumerate(asked):
        known = [(vocabulary[t], n) for t, n in terms if frequencies[vocabulary[t]]]
        codes = [c for c, _ in known]
        pairs = []
        for a, b in choose_pairs(codes, frequencies, corpus.holding):
            if codes[a] > codes[b]:
                a, b = b, a
            pairs.append((a, b, numbers.setdefault((codes[a], codes[b]), len(numbers))))
        queries.append(
            Query(number, np.array(codes, np.int64), np.array([n for _, n in known], np.int64), weights[codes] if codes else np.empty(0, np.int64),
                  np.array(pairs, np.int64).reshape(-1, 3))
        )
    return corpus, vocabulary, weights, np.array(list(numbers), np.int64).reshape(-1, 2), queries


def top_documents(
    docs: DataFrame, queries: DataFrame, k: int = TOP, shard_bytes: int = SHARD_BYTES, shard_docs: int = SHARD_DOCS, query_bytes: int = QUERY_BYTES
) -> DataFrame:
    """(query_id, rank, doc_id, score): the ``k`` best of docs (doc_id, text) for each of queries (query_id, text)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "pair-search")
    index = scratch.put(build_index(docs, shard_bytes, shard_docs), "index")
    figures = index.agg(F.sum("holding"), F.sum("length")).first()
    corpus = Corpus(figures[0] or 0, figures[1] or 0)
    wanted = queries.select(F.col("query_id").cast("long").alias("query_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    asked = scratch.put(wanted.mapInArrow(_query_terms, "query_id long, term binary").groupBy("query_id", "term").agg(F.count("*").alias("times")), "asked")
    size = asked.agg(F.sum(F.octet_length("term") + 32)).first()[0] or 0
    batches = int(size // query_bytes) + 1
    answers = []
    for number in range(batches):
        mine = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(batches)) == number)
        # About query_bytes, whatever the number of queries.
        held = [
            (r["query_id"], sorted((bytes(t["term"]), t["times"]) for t in r["terms"]))
            for r in mine.groupBy("query_id").agg(F.collect_list(F.struct("term", "times")).alias("terms")).collect()
        ]
        vocabulary = {t: n for n, t in enumerate(sorted({t for _, terms in held for t, _ in terms}))}
        counted = index.select("words", "starts").mapInArrow(_frequency_task(spark.sparkContext.broadcast(vocabulary)), "code long, held long")
        frequencies = np.zeros(len(vocabulary), np.int64)
        for r in counted.groupBy("code").agg(F.sum("held").alias("held")).collect():
            frequencies[r["code"]] = r["held"]
        sent = spark.sparkContext.broadcast(_plan(held, corpus, vocabulary, frequencies))
        ready = scratch.put(index.mapInArrow(_ready_task(sent), _READY_SQL), f"ready-{number}")
        found = ready.mapInArrow(_search_task(sent, k), "number long, doc_id long, score long")
        names = spark.createDataFrame([(n, q) for n, (q, _) in enumerate(held)], "number long, query_id long")
        answers.append(scratch.put(found.join(F.broadcast(names), "number").drop("number"), f"answers-{number}"))
        scratch.drop(ready)
    return scratch.result(_merge(functools.reduce(DataFrame.unionByName, answers), k))


def _merge(found: DataFrame, k: int) -> DataFrame:
    """The k best of all tasks' lists, first within parts of each query's list, then of the parts' best."""
    order = [F.desc("score"), F.col("doc_id").asc_nulls_first()]
    parted = found.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGE_PARTS)))
    some = parted.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "part").orderBy(*order))).where(F.col("rank") <= k)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "doc_id", "score")
