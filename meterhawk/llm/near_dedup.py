"""Near-duplicate groups by min-max hashing of word shingles, every link confirmed on full sets.

Under each permutation of the shingle hashes both the least and the greatest value are kept, so a signature
needs half the hash evaluations of one that keeps the least only. Bands of values, one half from the minima and one
from the maxima, deal documents into buckets. ``band_rows`` derives their size from the threshold, so that two documents
at it share no band with a chance of ``MISSED`` at most: 6 rows at 0.85 (3 in 10 million), 4 rows at 0.80 (1 in 100 billion).

Documents with the same shingle set are one node from the start. No step writes out all pairs of a bucket. First
the least node of each bucket is compared with its other members, links are confirmed on the full shingle sets, and
members are contracted by connected component. A bucket whose members have met in one component is done. Members
of the others, as around a passage that many documents share, are dealt again by the rarest shingles of
their full sets, in which any two linked ones must meet, so nothing is lost. There a bucket is
worked off in blocks, each pair of blocks in a task of its own that compares what is not yet connected and returns
links only. So every pair of a bucket is either confirmed, refuted or already connected.

Words are runs of characters other than space and the controls 9 to 13, after A-Z is lower-cased. A text of
fewer than five words has its whole sequence as its one shingle. Defined cases: a text without words or a null
text has an empty set, is linked with nothing and stays; a null id has no component and stays; rows that
repeat an id are one document if their texts are linked or both are the least id of their text; ties take the
least id; an empty table gives an empty result; other columns are ignored by ``near_duplicates`` and carried by
``keep_one``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterhawk.llm.common import Scratch, giving_back
from meterhawk.llm.components import star_labels

SHINGLE_WORDS = 5
PERMUTATIONS = 96
# Chance that two documents just at the threshold meet in no band.
MISSED = 5e-7
SIMILAR = (85, 100)
SEED = 1_315_423_911
# Members of a bucket that one task compares with as many others.
BLOCK = 256
REMEMBERED_WORDS = 300_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 4096


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_words = _Words()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _MIX
    return values ^ (values >> np.uint64(29))


def shingles(text: bytes, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    # Both work on ASCII only: A-Z, and exactly the white space that parts words.
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    taken = min(width, len(words))
    out = np.full(len(words) - taken + 1, np.uint64(taken))
    for at in range(taken):
        out = _mixed(out + hashes[at : len(words) - taken + 1 + at])
    return np.unique(out)


def permutations(count: int = PERMUTATIONS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and addends, each a permutation of the 64-bit numbers."""
    draw = np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, (2, count), np.uint64)
    return draw[0] | np.uint64(1), draw[1]


def minmax(hashes: np.ndarray, factors: np.ndarray, addends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of a non-empty set under each permutation."""
    low = np.full(len(factors), np.uint64(2**64 - 1))
    high = np.zeros(len(factors), np.uint64)
    for start in range(0, len(hashes), _BLOCK):
        values = factors[:, None] * hashes[None, start : start + _BLOCK] + addends[:, None]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return low, high


def band_rows(similar: tuple[int, int], count: int = PERMUTATIONS) -> int:
    """The most rows of a band with which pairs at the threshold are missed no more often than ``MISSED``."""
    share = similar[0] / similar[1]
    fitting = [rows for rows in range(1, count + 1) if count % rows == 0 and (1 - share**rows) ** (2 * count // rows) <= MISSED]
    return max(fitting, default=1)


def band_keys(low: np.ndarray, high: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of minima and of maxima; bands never share a key by position."""
    values = np.concatenate([low, high]).reshape(-1, rows)
    keys = np.arange(1, len(values) + 1, dtype=np.uint64)
    for at in range(rows):
        keys = _mixed(keys + values[:, at])
    return keys.view(np.int64)


def _signatures(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, addends = permutations()
        for batch in batches:
            sizes, digests, bands = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text)
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                bands.append(band_keys(*minmax(found, factors, addends), rows) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["id", "text_hash", "n_shingles", "digest", "bands"],
            )

    return run


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 200):
            part = batch.slice(start, 200)
            sets = [shingles(text).view(np.int64) for text in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "hashes"])


def _linked(a: Column, b: Column, similar: tuple[int, int]) -> Column:
    both = F.size(F.array_intersect(a, b))
    return similar[1] * both >= similar[0] * (F.size(a) + F.size(b) - both)


def _sizes_fit(a: Column, b: Column, similar: tuple[int, int]) -> Column:
    """Whether sets of these sizes can be linked at all."""
    return similar[1] * F.least(a, b) >= similar[0] * F.greatest(a, b)


def _confirmed(pairs: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """The linked ones of the pairs (a, b)."""
    sizes = sets.select("node", F.size("hashes").alias("size"))
    sized = (
        pairs.join(sizes.toDF("a", "size_a"), "a")
        .join(sizes.toDF("b", "size_b"), "b")
        .where(_sizes_fit(F.col("size_a"), F.col("size_b"), similar))
        .select("a", "b")
    )
    held = sized.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    return held.where(_linked(F.col("set_a"), F.col("set_b"), similar)).select("a", "b")


def _in_components(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their component, of the buckets that still hold more than one."""
    labelled = members.join(labels, "node", "left").withColumn("component", F.coalesce("label", "node")).drop("label")
    held = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return labelled.join(held.where("low < high").select("key"), "key")


def _distinct_buckets(members: DataFrame) -> DataFrame:
    """Of buckets with the same members one is kept; two linked sets often share many of their rarest shingles."""
    prints = [F.bit_xor(F.xxhash64("node", F.lit(turn))).alias(f"print_{turn}") for turn in (1, 2)]
    held = members.groupBy("key").agg(F.count("*").alias("size"), *prints)
    first = held.groupBy("size", "print_1", "print_2").agg(F.min("key").alias("key")).select("key")
    return members.join(first, "key")


def _by_rare_shingles(nodes: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Buckets (key, node, n) in which any two linked ones of ``nodes`` meet.

    In one order of all shingles, rarest first, two linked sets share one of their first ``n - need + 1``
    shingles each, where ``need`` is the least number of an n-set's shingles that a linked set shares. Shingles
    that only one node holds come first and need no bucket.
    """
    held = sets.join(nodes, "node", "left_semi")
    spread = held.select("node", F.size("hashes").alias("n"), F.explode("hashes").alias("key"))
    shared = spread.groupBy("key").agg(F.count("*").alias("holders")).where("holders > 1")
    ordered = (
        spread.join(shared, "key")
        .groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("holders", "key"))).alias("common"))
    )
    need = F.call_function("div", F.col("n") * similar[0] + similar[1] - 1, F.lit(similar[1]))
    first = F.size("common") - need + 1
    return ordered.where(first > 0).select(F.explode(F.slice("common", F.lit(1), first)).alias("s"), "node", "n").select("s.key", "node", "n")


def _compare(similar: tuple[int, int]):
    """The links between the two blocks of one bucket that are not yet connected."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        node, block = rows["node"].to_numpy(), rows["block"].to_numpy()
        key, crossed = rows["key"].iat[0], rows["low"].iat[0] != rows["high"].iat[0]
        component = np.unique(rows["component"].to_numpy(), return_inverse=True)[1]
        sets, keys = list(rows["hashes"]), list(rows["keys"])
        sizes = np.array([len(x) for x in sets])
        found = []
        for at in range(len(rows) - 1):
            after = np.arange(at + 1, len(rows))
            least, most = np.minimum(sizes[at], sizes[after]), np.maximum(sizes[at], sizes[after])
            apart = (component[after] != component[at]) & (similar[1] * least >= similar[0] * most)
            if crossed:
                apart &= block[after] != block[at]
            for other in after[apart]:
                if component[other] == component[at] or np.intersect1d(keys[at], keys[other], True)[0] != key:
                    continue  # connected meanwhile, or compared in the first bucket that both are in
                both = len(np.intersect1d(sets[at], sets[other], True))
                if similar[1] * both >= similar[0] * (sizes[at] + sizes[other] - both):
                    found.append((node[at], node[other]))
                    component[component == component[other]] = component[at]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def _linked_in_blocks(rest: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Links (a, b) that connect the components of the open buckets, found without writing out pairs.

    A bucket is cut into blocks; each block meets each other one in a task of its own.
    """
    counts = rest.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    held = rest.groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("keys")).join(sets, "node")
    dealt = (
        rest.join(counts, "key")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("key", "node", "component", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    )
    return dealt.join(held, "node").groupBy("key", "low", "high").applyInPandas(_compare(similar), "a long, b long")


def _links(rows: DataFrame, signed: DataFrame, classes: DataFrame, scratch: Scratch, similar: tuple[int, int]) -> DataFrame:
    """Component labels (node, label) of the nodes that have a link."""
    # One row stands for each set; rows that are equal to it in id and text may stand beside it.
    nodes = signed.join(classes, ["digest", "id", "text_hash"]).select("node", "bands")
    banded = nodes.select(F.explode("bands").alias("key"), "node")
    shared = banded.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead < last")
    members = scratch.put(banded.join(shared.select("key", "lead"), "key"), "members")
    wanted = members.select("node").distinct().join(classes.select("node", "id", "text_hash"), "node")
    texts = rows.join(wanted, ["id", "text_hash"]).select("node", "text")
    sets = scratch.put(texts.mapInArrow(giving_back(_full_sets), "node long, hashes array<long>"), "sets")

    pairs = members.where("node != lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    edges = scratch.put(_confirmed(pairs, sets, similar), "links")
    labels = star_labels(edges, scratch)
    unmet = _in_components(members.where("node != lead").select("key", "node"), labels)
    unmet = scratch.put(unmet.select("node").distinct(), "unmet")
    rest = scratch.put(_in_components(_distinct_buckets(_by_rare_shingles(unmet, sets, similar)), labels), "open")
    scratch.drop(members, unmet)
    more = scratch.put(_linked_in_blocks(rest, sets, similar).unionByName(edges), "links")
    joined = star_labels(more, scratch)
    scratch.drop(rest, edges, more, labels, sets)
    return joined


def _content(text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")


def _grouped(docs: DataFrame, id_col: str, text_col: str, similar: tuple[int, int], scratch: Scratch) -> DataFrame:
    """One row per input row: id, text_hash, n_shingles, group (null for rows that are linked with nothing), component_id, kept."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), _content(text_col).alias("text"))
    hashed = rows.withColumn("text_hash", F.xxhash64("text"))
    signed = scratch.put(
        hashed.mapInArrow(
            giving_back(_signatures(band_rows(similar))), "id long, text_hash long, n_shingles long, digest binary, bands array<long>"
        ),
        "signatures",
    )
    can_link = F.col("digest").isNotNull() & F.col("id").isNotNull()
    full = signed.where(can_link)
    # A set is a node of its own, whichever ids its rows have.
    least = full.groupBy("digest").agg(F.min(F.struct("id", "text_hash")).alias("least"))
    classes = scratch.put(least.select("digest", "least.id", "least.text_hash", F.monotonically_increasing_id().alias("node")), "classes")
    labels = _links(hashed, full, classes, scratch, similar)
    groups = scratch.put(
        classes.join(labels, "node", "left").select("digest", "id", F.coalesce("label", "node").alias("group")), "groups"
    )
    firsts = groups.groupBy("group").agg(F.min("id").alias("component_id"))
    found = (
        full.select("id", "text_hash", "n_shingles", "digest")
        .join(groups.select("digest", "group").join(firsts, "group"), "digest")
        .select("id", "text_hash", "n_shingles", "group", "component_id")
    )
    alone = signed.where(~can_link).select("id", "text_hash", "n_shingles", F.lit(None).cast("long").alias("group"), F.col("id").alias("component_id"))
    return scratch.result(
        found.unionByName(alone).select(
            "id",
            "text_hash",
            "n_shingles",
            "group",
            "component_id",
            F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
        )
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: tuple[int, int] = SIMILAR
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (least id reachable over links), kept."""
    groups = _grouped(docs, id_col, text_col, similar, Scratch(docs.sparkSession, "near"))
    return groups.select(F.col("id").alias(id_col), "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns as they were, whatever their names.

    A group keeps exactly one row: one with its least id and, of those, the least text hash. So rows that repeat an id with other
    texts stay, each for its own group. Rows that are linked with nothing, for want of words or of an id, all stay.
    """
    groups = _grouped(docs, id_col, text_col, similar, Scratch(docs.sparkSession, "near")).where(F.col("group").isNotNull())
    first = groups.groupBy("group").agg(F.min(F.struct("id", "text_hash")).alias("first"))
    # What leads a group, and how many of its rows are equal to that in id and text.
    leads = groups.join(first, "group").where(F.struct("id", "text_hash") == F.col("first"))
    repeated = leads.groupBy("id", "text_hash").agg(F.count("*").alias("rows")).where("rows > 1").select("id", "text_hash")
    gone = groups.join(first, "group").where(F.struct("id", "text_hash") != F.col("first")).select("id", "text_hash").distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    packed = docs.select(row, F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(_content(text_col)).alias("text_hash"))
    stay = packed.join(gone, ["id", "text_hash"], "left_anti")
    if not repeated.isEmpty():
        once = stay.join(repeated, ["id", "text_hash"], "left_semi").groupBy("id", "text_hash").agg(F.first("row").alias("row"))
        stay = stay.join(repeated, ["id", "text_hash"], "left_anti").select("row").unionByName(once.select("row"))
    return stay.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
