"""Exact top-k search by BM25: an inverted index with block-max WAND, per shard and merged exactly.

Documents are cut, where they lie, into shards closed by bytes of text or by documents; a shard is one row of the index, and no
text is shuffled. A shard puts documents that share its commonest terms side by side and cuts them into ranges
of ``RANGE_DOCS``. Every posting list is cut at the same ranges, and each piece has the greatest term weight in it.

A query keeps a cursor in each of its terms' lists and a threshold, the k-th best score so far. The pivot is the next range, in document
order, in which the maxima of the pieces add up to the threshold; all cursors jump to their pieces
of it, and the pieces passed over are never read. As all lists are cut alike, the pivots ahead are found for many ranges in one step, and
again whenever the threshold has risen. A shard whose own term maxima fall short is passed over whole. Weights use the global
document count, mean length and document frequencies, so scores of different shards compare and the k best of
all lists are the exact answer. A task carries its k best, and so its threshold, from shard to shard. Ties go to the least id, a null id first.

Whole texts as queries open nearly every range, and one at a time they pay for every posting. A batch of many queries is therefore
held against blocks of documents: terms that many pairs of a block share are multiplied as matrices, the others
go through the lists of the queries that hold them. This is done in single precision; whatever may reach the k-th best by the bound of its
rounding is added up again in double precision, in the order of the terms, as for a single query. One shard in ``SEEDS`` is searched
first, and its k-th best score is what the other shards must reach from the start. Which way is taken does not show in the result.

Queries run in batches of bounded bytes, each against all shards. Defined cases: rows of one query id are one query holding all their
terms; a null query id is no query; a null document id is found like any other; a text without words matches nothing and, as a
query, finds nothing; repeated rows are separate documents; an empty table gives an empty result; other columns are
ignored. A document longer than a shard is a shard of its own. Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterhawk.llm.common import Scratch, give_back, giving_back
from meterhawk.llm.near_dedup import word_hashes

K1 = 1.2
B = 0.75
TOP = 10
SHARD_BYTES = 16 << 20
SHARD_DOCS = 16_384
RANGE_DOCS = 64
BATCH_BYTES = 24 << 20
MERGE_PARTS = 64
# Documents of a shard are ordered by which of its commonest terms they hold.
_ORDER_TERMS = 32
# A bound may fall below the sum of the same terms by rounding.
_SLACK = 1 - 1e-9
# A batch of this many queries is held against blocks of documents.
MANY = 64
# The share of shards that such a batch searches first.
SEEDS = 32
# Bytes that a query's term takes in a batch: its code, its gain and its entry in the term's list.
TERM_BYTES = 20
# Queries and cells (documents times queries) of a block, terms of one product of matrices, and list entries looked up at once.
BLOCK_QUERIES = 8_192
BLOCK_CELLS = 4 << 20
BLOCK_TERMS = 1_024
LIST_ENTRIES = 24_576
# A term goes into the product where more than this share of a block's pairs have it in common: so many times dearer is a list's entry.
_DENSE_SHARE = 2e-3

# A shard has at most SHARD_DOCS documents and, as every text is shorter than 2 GB, fewer than 2 ** 31 postings.
_INDEX = {"ids": np.int64, "known": np.int8, "lengths": np.int32, "terms": np.uint64, "starts": np.int32, "docs": np.uint16, "times": np.int32}
_INDEX_SQL = "holding bigint, length bigint, " + ", ".join(f"{c} binary" for c in _INDEX)


def terms_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct term hashes and their counts."""
    return np.unique(word_hashes(text.lower().split()), return_counts=True)


def _alike(terms: np.ndarray, docs: np.ndarray, size: int) -> np.ndarray:
    """The documents, ordered by which of the commonest terms they hold."""
    names, held = np.unique(terms, return_counts=True)
    common = names[np.argsort(-held, kind="stable")[:_ORDER_TERMS]]
    marks = np.zeros(size, np.uint64)
    for n, term in enumerate(common):
        marks[docs[terms == term]] |= np.uint64(1 << (_ORDER_TERMS - 1 - n))
    return np.argsort(marks, kind="stable")


def build_shard(ids: list[int | None], bags: list[tuple[np.ndarray, np.ndarray]]) -> dict[str, np.ndarray]:
    """The index of documents given by their terms and counts; postings by term, then document."""
    sizes = [len(t) for t, _ in bags]
    docs = np.repeat(np.arange(len(bags), dtype=_INDEX["docs"]), sizes)
    terms = np.concatenate([np.empty(0, np.uint64), *(t for t, _ in bags)])
    times = np.concatenate([np.empty(0, np.int64), *(c for _, c in bags)]).astype(_INDEX["times"])
    order = _alike(terms, docs, len(bags))
    place = np.empty(len(bags), docs.dtype)
    place[order] = np.arange(len(bags))
    docs = place[docs]
    by_term = np.lexsort((docs, terms))
    terms, docs, times = terms[by_term], docs[by_term], times[by_term]
    first = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])[: len(terms)])
    lengths = np.bincount(docs, times, len(bags))
    found = {
        "ids": [0 if ids[i] is None else ids[i] for i in order], "known": [ids[i] is not None for i in order], "lengths": lengths,
        "terms": terms[first], "starts": np.append(first, len(terms)), "docs": docs, "times": times,
    }
    return {name: np.asarray(found[name], kind) for name, kind in _INDEX.items()}


def _index_task(shard_bytes: int, shard_docs: int):
    def row(ids: list, bags: list) -> pa.RecordBatch:
        index = build_shard(ids, bags)
        figures = [pa.array([len(ids)], pa.int64()), pa.array([int(index["lengths"].sum(dtype=np.int64))], pa.int64())]
        return pa.RecordBatch.from_arrays(
            [*figures, *(pa.array([index[name].tobytes()], pa.binary()) for name in _INDEX)], names=["holding", "length", *_INDEX]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, bags, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                text = text.as_py()
                ids.append(doc_id.as_py())
                terms, counts = terms_of(text)
                bags.append((terms, counts.astype(_INDEX["times"])))
                held += len(text)
                if held >= shard_bytes or len(ids) >= shard_docs:
                    yield row(ids, bags)
                    ids, bags, held = [], [], 0
        if ids:
            yield row(ids, bags)

    return run


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """The index rows of docs (doc_id, text), one per shard. No task holds more than a shard's postings."""
    if not 0 < shard_docs <= 1 << 16:
        raise ValueError("a shard has 1 to 65,536 documents")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(giving_back(_index_task(shard_bytes, shard_docs)), _INDEX_SQL)


def _spread(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, one range after the other, and the sizes of the ranges."""
    sizes = stops - starts
    numbers = np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
    numbers += np.arange(len(numbers))
    return numbers, sizes


class Best:
    """The k best of a query so far: highest score, then null id, then least id."""

    def __init__(self, k: int):
        self.k, self.scores, self.known, self.ids = k, np.empty(0), np.empty(0, np.int8), np.empty(0, np.int64)

    @property
    def threshold(self) -> float:
        """What a document must score to be among the k best, ties included."""
        return self.scores[-1] if len(self.scores) == self.k else 0.0

    def add(self, scores: np.ndarray, known: np.ndarray, ids: np.ndarray) -> None:
        scores, known, ids = np.concatenate((self.scores, scores)), np.concatenate((self.known, known)), np.concatenate((self.ids, ids))
        order = np.lexsort((ids, known, -scores))[: self.k]
        self.scores, self.known, self.ids = scores[order], known[order], ids[order]


def _met(terms: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``terms`` are in ``vocabulary``, and their places there; both sorted."""
    at = np.searchsorted(vocabulary, terms)
    at[at == len(vocabulary)] = 0
    met = np.flatnonzero(vocabulary[at] == terms) if len(vocabulary) else np.empty(0, np.int64)
    return met, at[met]


def _weights(times: np.ndarray, lengths: np.ndarray, mean_length: float) -> np.ndarray:
    times = times.astype(float)
    return times * (K1 + 1) / (times + K1 * (1 - B + B * lengths / mean_length))


class Shard:
    """A shard as queries over ``vocabulary`` (sorted term hashes) read it."""

    def __init__(self, index: dict[str, np.ndarray], vocabulary: np.ndarray, mean_length: float, range_docs: int = RANGE_DOCS):
        self.ids, self.known, self.range_docs = index["ids"], index["known"], range_docs
        self.ranges = -(-len(self.ids) // range_docs)
        # Only the lists that the batch asks for.
        met, at = _met(index["terms"], vocabulary)
        self.place = np.full(len(vocabulary), -1, np.int64)
        self.place[at] = np.arange(len(met))
        postings, sizes = _spread(index["starts"][met].astype(np.int64), index["starts"][met + 1].astype(np.int64))
        of = np.repeat(np.arange(len(met)), sizes)
        self.docs = index["docs"][postings].astype(np.int64)
        self.weights = _weights(index["times"][postings], index["lengths"][self.docs], mean_length)
        range_of = self.docs // range_docs
        fresh = np.ones(len(of), bool)
        fresh[1:] = (of[1:] != of[:-1]) | (range_of[1:] != range_of[:-1])
        first = np.flatnonzero(fresh)
        # Pieces of the lists: where each list's begin, the range of each, its first posting and greatest weight.
        self.cuts = np.searchsorted(of[first], np.arange(len(met) + 1))
        self.piece_range = range_of[first]
        self.starts = np.append(first, len(of))
        self.peaks = np.maximum.reduceat(self.weights, first) if len(first) else self.weights
        self.tops = np.maximum.reduceat(self.peaks, self.cuts[:-1]) if len(met) else self.peaks

    def search(self, codes: np.ndarray, gains: np.ndarray, best: Best) -> int:
        """Add to ``best`` what the shard has for terms, by place in the vocabulary, and their gains; the postings read."""
        at = self.place[codes]
        known = at >= 0
        at, gains = at[known], gains[known]
        least = best.threshold * _SLACK
        if not len(at) or gains @ self.tops[at] < least:
            return 0
        pieces, sizes = _spread(self.cuts[at], self.cuts[at + 1])
        ranges, gains = self.piece_range[pieces], np.repeat(gains, sizes)
        bounds = np.bincount(ranges, self.peaks[pieces] * gains, self.ranges)
        pivots = np.flatnonzero((bounds > 0) & (bounds >= least))
        step, read = 16, 0
        while len(pivots):
            some, pivots = pivots[:step], pivots[step:]
            open_ = np.zeros(self.ranges, bool)
            open_[some] = True
            chosen = np.flatnonzero(open_[ranges])
            postings, sizes = _spread(self.starts[pieces[chosen]], self.starts[pieces[chosen] + 1])
            low, high = some[0] * self.range_docs, min((some[-1] + 1) * self.range_docs, len(self.ids))
            scores = np.bincount(self.docs[postings] - low, self.weights[postings] * np.repeat(gains[chosen], sizes), high - low)
            read += len(postings)
            hit = np.flatnonzero((scores > 0) & (scores >= best.threshold))
            if len(hit):
                best.add(scores[hit], self.known[low + hit], self.ids[low + hit])
            pivots = pivots[bounds[pivots] >= best.threshold * _SLACK]
            step *= 2
        return read


class Leaders:
    """The k best of each of many queries so far, in the order of ``Best``; no query needs scores below its floor."""

    def __init__(self, floors: np.ndarray, k: int):
        queries = len(floors)
        self.floors, self.k, self.found = floors, k, np.zeros(queries, np.int64)
        self.scores, self.known, self.ids = np.zeros((queries, k)), np.zeros((queries, k), np.int8), np.zeros((queries, k), np.int64)

    @property
    def thresholds(self) -> np.ndarray:
        """As in ``Best``: scores are above zero, and the places not yet taken hold zeros."""
        return np.maximum(self.scores[:, -1], self.floors)

    def add(self, queries: np.ndarray, scores: np.ndarray, known: np.ndarray, ids: np.ndarray) -> None:
        touched, at = np.unique(queries, return_inverse=True)
        row, place = np.nonzero(np.arange(self.k) < self.found[touched][:, None])
        old = touched[row], place
        row = np.concatenate((row, at))
        scores, known, ids = np.concatenate((self.scores[old], scores)), np.concatenate((self.known[old], known)), np.concatenate((self.ids[old], ids))
        order = np.lexsort((ids, known, -scores, row))
        row = row[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        order, row, rank = order[rank < self.k], touched[row[rank < self.k]], rank[rank < self.k]
        self.scores[row, rank], self.known[row, rank], self.ids[row, rank] = scores[order], known[order], ids[order]
        self.found[row] = rank + 1  # ranks ascend within a query, so its last one stays


class Asked:
    """Many queries over ``vocabulary`` (sorted term hashes): query n has the codes and gains from cuts[n] to cuts[n + 1], codes ascending."""

    def __init__(self, vocabulary: np.ndarray, cuts: np.ndarray, codes: np.ndarray, gains: np.ndarray):
        # Only the terms that these queries hold.
        held = np.bincount(codes, minlength=len(vocabulary))
        asked = np.flatnonzero(held)
        self.vocabulary, self.cuts, self.gains = vocabulary[asked], cuts, gains
        place = np.zeros(len(vocabulary), np.int32)
        place[asked] = np.arange(len(asked))
        self.codes = place[codes]
        self.count = len(cuts) - 1
        sizes = np.diff(cuts)
        # Sums of so many numbers of either precision, each rounded at every step, differ by less than this.
        self.slack = np.maximum(1 - (sizes + 8) * 2.0**-23, 0)
        # The queries of each term: the query in the upper half of a number, the bits of its gain in the lower one.
        self.held = held[asked]
        self.starts = np.append(0, np.cumsum(self.held))
        order = np.argsort(self.codes, kind="stable")
        bits = gains[order].astype(np.float32).view(np.uint32).astype(np.int64)
        self.lists = (np.repeat(np.arange(self.count), sizes)[order] << 32) | bits

    def look_up(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The queries and gains of list entries."""
        entries = self.lists.take(entries)
        gains = entries.astype(np.uint32).view(np.float32)
        entries >>= 32
        return entries, gains


class Documents:
    """A shard by document, as many queries read it at once."""

    def __init__(self, index: dict[str, np.ndarray], asked: Asked, mean_length: float):
        self.ids, self.known, self.asked = index["ids"], index["known"], asked
        met, at = _met(index["terms"], asked.vocabulary)
        postings, sizes = _spread(index["starts"][met].astype(np.int64), index["starts"][met + 1].astype(np.int64))
        docs = index["docs"][postings]
        # Postings come by term, so a document's stay in the order of its codes.
        order = np.argsort(docs, kind="stable")
        docs = docs[order]
        self.codes = np.repeat(at, sizes)[order]
        self.weights = _weights(index["times"][postings[order]], index["lengths"][docs], mean_length)
        self.cuts = np.append(0, np.cumsum(np.bincount(docs, minlength=len(self.ids))))
        self.of_doc = np.zeros(len(asked.vocabulary))

    def near_scores(self, low: int, high: int) -> np.ndarray:
        """The scores of documents low to high for all queries, in single precision."""
        asked, some = self.asked, slice(self.cuts[low], self.cuts[high])
        codes, weights = self.codes[some], self.weights[some].astype(np.float32)
        docs = np.repeat(np.arange(high - low), np.diff(self.cuts[low : high + 1]))
        shared = np.bincount(codes, minlength=len(asked.held)) * asked.held
        dense = np.flatnonzero(shared > _DENSE_SHARE * (high - low) * asked.count)
        column = np.full(len(asked.held), -1)
        column[dense] = np.arange(len(dense))
        columns = column[codes]
        scores = np.zeros((high - low, asked.count), np.float32)
        for first in range(0, len(dense), BLOCK_TERMS):
            terms = dense[first : first + BLOCK_TERMS]
            mine = np.flatnonzero((columns >= first) & (columns < first + len(terms)))
            left = np.zeros((high - low, len(terms)), np.float32)
            left[docs[mine], columns[mine] - first] = weights[mine]
            entries, sizes = _spread(asked.starts[terms], asked.starts[terms + 1])
            queries, gains = asked.look_up(entries)
            right = np.zeros((len(terms), asked.count), np.float32)
            right[np.repeat(np.arange(len(terms)), sizes), queries] = gains
            if first:
                scores += left @ right
            else:
                np.matmul(left, right, out=scores)
        rest = np.flatnonzero(columns < 0)
        codes, weights, docs = codes[rest], weights[rest], docs[rest] * asked.count
        starts, stops = asked.starts[codes], asked.starts[codes + 1]
        edges = np.flatnonzero(np.diff(np.cumsum(stops - starts) // LIST_ENTRIES)) + 1
        flat = scores.reshape(-1)
        for a, b in zip([0, *edges], [*edges, len(rest)], strict=True):
            entries, sizes = _spread(starts[a:b], stops[a:b])
            cells, gains = asked.look_up(entries)
            cells += np.repeat(docs[a:b], sizes)
            gains *= np.repeat(weights[a:b], sizes)
            np.add.at(flat, cells, gains)
        return scores

    def scores(self, docs: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """The scores of pairs that come by document, added up in the order of the terms."""
        asked, out = self.asked, np.empty(len(docs))
        edges = np.flatnonzero(np.diff(docs)) + 1
        for a, b in zip([0, *edges], [*edges, len(docs)], strict=True):
            own = slice(self.cuts[docs[a]], self.cuts[docs[a] + 1])
            self.of_doc[self.codes[own]] = self.weights[own]
            entries, sizes = _spread(asked.cuts[queries[a:b]], asked.cuts[queries[a:b] + 1])
            out[a:b] = np.bincount(np.repeat(np.arange(b - a), sizes), self.of_doc[asked.codes[entries]] * asked.gains[entries], b - a)
            self.of_doc[self.codes[own]] = 0
        return out

    def _raise(self, floors: np.ndarray, near: np.ndarray, queries: np.ndarray, k: int) -> None:
        """Raise the floors of some queries to what k documents of a block reach, less twice the bound of the rounding."""
        if len(queries) and len(near) >= k:
            at = len(near) - k
            reached = np.partition(near[:, queries], at, axis=0)[at] * self.asked.slack[queries] ** 2
            floors[queries] = np.maximum(floors[queries], reached.astype(np.float32))

    def search(self, best: Leaders) -> int:
        """Add to ``best`` what the shard has for the queries; the pairs scored in double precision."""
        step, paired = max(BLOCK_CELLS // self.asked.count, 1), 0
        for low in range(0, len(self.ids), step):
            high = min(low + step, len(self.ids))
            near = self.near_scores(low, high)
            # A score is above zero where a term is shared.
            wanted = best.thresholds
            floors = np.maximum((wanted * self.asked.slack).astype(np.float32), np.nextafter(np.float32(0), np.float32(1)))
            self._raise(floors, near, np.flatnonzero(wanted == 0), best.k)
            hit = np.flatnonzero(near >= floors)
            # A query that meets much better documents than so far learns from them first what must be reached.
            met = np.bincount(hit % self.asked.count, minlength=self.asked.count)
            self._raise(floors, near, np.flatnonzero(met > 4 * best.k), best.k)
            docs, queries = np.divmod(hit, self.asked.count)
            high_enough = near[docs, queries] >= floors[queries]
            docs, queries = docs[high_enough] + low, queries[high_enough]
            if len(docs):
                scores = self.scores(docs, queries)
                paired += len(docs)
                good = scores >= wanted[queries]
                docs = docs[good]
                best.add(queries[good], scores[good], self.known[docs], self.ids[docs])
        return paired


def _unpack(row: dict, columns=tuple(_INDEX)) -> dict[str, np.ndarray]:
    return {name: np.frombuffer(row[name], _INDEX[name]) for name in columns}


def _frequency_task(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value
        held = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                index = _unpack(row, ("terms", "starts"))
                # A shard's terms are fewer than the vocabulary's, so they are looked up there.
                term, at = _met(index["terms"], vocabulary)
                held[at] += index["starts"][term + 1] - index["starts"][term]
        met = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(vocabulary[met].view(np.int64)), pa.array(held[met])], names=["term", "held"])

    return giving_back(run)


def _holders(index: DataFrame, asked: DataFrame, batch_bytes: int, scratch: Scratch) -> DataFrame:
    """(term, held): the number of documents that hold a term of ``asked``, for all queries at once. Terms go in batches of bounded bytes."""
    named = scratch.put(asked.select("term").distinct(), "terms")
    batches = (named.count() * 8) // batch_bytes + 1
    counted = []
    for number in range(batches):
        some = named.where(F.pmod(F.xxhash64("term"), F.lit(batches)) == number).toArrow().column("term").to_numpy()
        sent = index.sparkSession.sparkContext.broadcast(np.sort(some.view(np.uint64)))
        counted.append(index.select("terms", "starts").mapInArrow(_frequency_task(sent), "term long, held long"))
    return functools.reduce(DataFrame.unionByName, counted).groupBy("term").agg(F.sum("held").alias("held"))


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for query, text in zip(batch.column("query_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            terms, counts = terms_of(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array([query] * len(terms), pa.int64()), pa.array(terms.view(np.int64)), pa.array(counts.astype(np.int64))],
                names=["query_id", "term", "times"],
            )


def _weighed(asked: DataFrame, docs: int) -> tuple[np.ndarray, ...]:
    """The vocabulary, the queries' names and cuts, and their codes and gains, codes ascending within a query."""
    rows = asked.select("query_id", "term", "times", F.coalesce("held", F.lit(0)).alias("held")).toArrow()
    names = rows.column("query_id").to_numpy()
    vocabulary, codes = np.unique(rows.column("term").to_numpy().view(np.uint64), return_inverse=True)
    codes = codes.astype(np.int32)
    order = np.lexsort((codes, names))
    holders = rows.column("held").to_numpy()
    gains = rows.column("times").to_numpy() * np.log1p((docs - holders + 0.5) / (holders + 0.5))
    each, first = np.unique(names[order], return_index=True)
    return vocabulary, each, np.append(first, len(order)), codes[order], gains[order]


def _batch(vocabulary: np.ndarray, names: np.ndarray, cuts: np.ndarray, codes: np.ndarray, gains: np.ndarray, mean_length: float) -> tuple:
    """What is sent of a batch of queries: (names, blocks of many queries or else none, what single queries need)."""
    if len(names) < MANY:
        return names, [], (vocabulary, mean_length, cuts, codes, gains)
    blocks = []
    for n in range(0, len(names), BLOCK_QUERIES):
        own = cuts[n : n + BLOCK_QUERIES + 1]
        some = slice(own[0], own[-1])
        blocks.append(Asked(vocabulary, own - own[0], codes[some], gains[some]))
    return names, blocks, (mean_length,)


def _search_task(sent, k: int, floors=None):
    """``sent`` holds a batch, ``floors`` the scores that are known to be among the k best of its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, blocks, rest = sent.value
        shards = (_unpack(row) for batch in batches for row in batch.to_pylist())
        found = _find_many(shards, blocks, *rest, k, floors.value if floors else np.zeros(len(names))) if blocks else _find_few(shards, *rest, k)
        for numbers, scores, known, ids in found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[numbers], pa.int64()), pa.array(ids, pa.int64(), mask=known == 0), pa.array(scores)], names=["query_id", "doc_id", "score"]
            )

    return giving_back(run)


def _find_few(shards, vocabulary, mean_length, cuts, codes, gains, k):
    """(numbers of queries, scores, known, ids) of the k best of all shards, each query by itself."""
    best = [Best(k) for _ in cuts[1:]]
    for index in shards:
        shard = Shard(index, vocabulary, mean_length)
        for n, mine in enumerate(best):
            own = slice(cuts[n], cuts[n + 1])
            shard.search(codes[own], gains[own], mine)
    for n, mine in enumerate(best):
        if len(mine.ids):
            yield np.full(len(mine.ids), n), mine.scores, mine.known, mine.ids


def _find_many(shards, blocks, mean_length, k, floors):
    """As ``_find_few``, the queries of a block all at once, less what falls short of the floors."""
    starts = np.cumsum([0, *(asked.count for asked in blocks)])
    best = [Leaders(floors[a:b], k) for a, b in zip(starts, starts[1:])]
    for index in shards:
        for asked, mine in zip(blocks, best, strict=True):
            Documents(index, asked, mean_length).search(mine)
    for start, mine in zip(starts, best):
        number, rank = np.nonzero(np.arange(k) < mine.found[:, None])
        yield start + number, mine.scores[number, rank], mine.known[number, rank], mine.ids[number, rank]


def _find(index: DataFrame, seed: Column, batch: tuple, k: int, scratch: Scratch, name: str) -> list[DataFrame]:
    """(query_id, doc_id, score) tables with the k best of the index for a batch, and some more. Many queries search the seeds first."""
    context = index.sparkSession.sparkContext
    sent = context.broadcast(batch)

    def search(shards: DataFrame, part: str, floors=None) -> DataFrame:
        found = shards.select(*_INDEX).mapInArrow(_search_task(sent, k, floors), "query_id long, doc_id long, score double")
        return scratch.put(found, f"{name}-{part}")

    if not batch[1]:
        return [search(index, "all")]
    first = search(index.where(seed), "first")
    last = _merge(first, k).where(F.col("rank") == k).select("query_id", "score").toArrow()
    floors = np.zeros(len(batch[0]))
    floors[np.searchsorted(batch[0], last.column("query_id").to_numpy())] = last.column("score").to_numpy()
    found = [first, search(index.where(~seed), "rest", context.broadcast(floors))]
    sent.destroy()
    return found


def top_documents(
    docs: DataFrame, queries: DataFrame, k: int = TOP, shard_bytes: int = SHARD_BYTES, shard_docs: int = SHARD_DOCS, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best of ``docs`` (doc_id, text) for each of ``queries`` (query_id, text)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    index = scratch.put(build_index(docs, shard_bytes, shard_docs), "index")
    mark = F.xxhash64("ids", "lengths")
    totals = index.agg(F.sum("holding"), F.sum("length"), F.min(mark)).first()
    # The least mark makes sure that there is one.
    seed = (F.pmod(mark, F.lit(SEEDS)) == 0) | (mark == F.lit(totals[2] or 0))
    n = totals[0] or 0
    mean_length = max((totals[1] or 0) / max(n, 1), 1e-9)
    wanted = queries.where(F.col("query_id").isNotNull()).select(
        F.col("query_id").cast("long").alias("query_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    )
    terms = wanted.mapInArrow(_query_terms, "query_id long, term long, times long").groupBy("query_id", "term").agg(F.sum("times").alias("times"))
    asked = scratch.put(terms, "asked")
    asked = scratch.put(asked.join(_holders(index, asked, batch_bytes, scratch), "term", "left"), "weighed")
    batches = (asked.count() * TERM_BYTES) // batch_bytes + 1
    answers = []
    for number in range(batches):
        # About batch_bytes, whatever the number of queries.
        some = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(batches)) == number)
        batch = _batch(*_weighed(some, n), mean_length)
        # What the driver needed to make a batch would else add up from batch to batch.
        give_back()
        answers += _find(index, seed, batch, k, scratch, f"answers-{number}")
    return scratch.result(_merge(functools.reduce(DataFrame.unionByName, answers), k))


def _merge(found: DataFrame, k: int) -> DataFrame:
    """The k best of all tasks' lists, first within parts of each query's list, then of the parts' best."""
    order = [F.desc("score"), F.col("doc_id").asc_nulls_first()]
    parted = found.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGE_PARTS)))
    some = parted.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "part").orderBy(*order))).where(F.col("rank") <= k)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "doc_id", "score")
