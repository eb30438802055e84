"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers.

Rows get a global number that depends on their content alone: a bucket from a hash of the row's key, the
bucket's offset, and the place within the bucket. The permutation maps numbers 0 to N - 1 onto themselves;
the shard is the new number modulo the shard count and the slot the quotient, so that shard counts differ by
one at most, slots have no gaps, and either direction can be computed for a single row.

The domain is a grid of ``rows x columns`` cells, just larger than N. One Feistel round adds a keyed hash of
one coordinate to the other, modulo its side, which can be undone; a value that falls outside N walks on
through the permutation until it is inside. Only N cells lie inside, so a walk has at most ``cells - N`` steps
outside.

Everything is DataFrame functions. Defined cases: a null text has size 1 and the checksum of the empty text;
null and repeated ids are ordered by checksum and size; rows equal in all three may swap places, which no
result shows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterhawk.llm.common import Scratch

SHARDS = 16
SEED = 20240917
ROUNDS = 6
# Bounds the offsets table, whatever the input; the largest bucket is sorted by one task.
BUCKETS = 4096
MOST_WALKS = 48


def grid(n: int) -> tuple[int, int]:
    """Sides of the smallest nearly square grid with at least ``n`` cells."""
    side = max(1, math.isqrt(max(n, 1)))
    return side, -(-max(n, 1) // side)


def _quotient(number: Column, side: int) -> Column:
    """Whole-number division, exact for every long."""
    return F.call_function("div", number, F.lit(side))


def _round_value(half: Column, turn: int, seed: int, side: int) -> Column:
    return F.pmod(F.xxhash64(half, F.lit(turn), F.lit(seed)), F.lit(side))


def permute_once(number: Column, n: int, seed: int = SEED) -> Column:
    rows, columns = grid(n)
    left, right = _quotient(number, columns), F.pmod(number, F.lit(columns))
    for turn in range(ROUNDS):
        if turn % 2 == 0:
            left = F.pmod(left + _round_value(right, turn, seed, rows), F.lit(rows))
        else:
            right = F.pmod(right + _round_value(left, turn, seed, columns), F.lit(columns))
    return left * F.lit(columns) + right


def restore_once(number: Column, n: int, seed: int = SEED) -> Column:
    rows, columns = grid(n)
    left, right = _quotient(number, columns), F.pmod(number, F.lit(columns))
    for turn in reversed(range(ROUNDS)):
        if turn % 2 == 0:
            left = F.pmod(left - _round_value(right, turn, seed, rows), F.lit(rows))
        else:
            right = F.pmod(right - _round_value(left, turn, seed, columns), F.lit(columns))
    return left * F.lit(columns) + right


def _walk(number: Column, n: int, step) -> Column:
    rows, columns = grid(n)
    walks = min(MOST_WALKS, rows * columns - n)
    moved = step(number)
    if walks > 0:
        turns = F.sequence(F.lit(1), F.lit(walks))
        moved = F.aggregate(turns, moved, lambda at, _: F.when(at < n, at).otherwise(step(at)))
        moved = F.when(moved < n, moved).otherwise(F.raise_error(F.lit("the walk did not end")).cast("long"))
    return moved


def permute(number: Column, n: int, seed: int = SEED) -> Column:
    """New place of row ``number`` among ``n`` rows."""
    return _walk(number.cast("long"), n, lambda at: permute_once(at, n, seed).cast("long"))


def restore(place: Column, n: int, seed: int = SEED) -> Column:
    """The row number whose new place is ``place``."""
    return _walk(place.cast("long"), n, lambda at: restore_once(at, n, seed).cast("long"))


def number_rows(rows: DataFrame, keys: list[str], scratch: Scratch) -> tuple[DataFrame, int]:
    """Add ``row_number`` from 0, the same however ``rows`` is partitioned, and return it with the row count."""
    bucketed = scratch.put(rows.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))), "keys")
    counts = bucketed.groupBy("bucket").count()
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    n = bucketed.count()
    placed = bucketed.join(F.broadcast(offsets), "bucket").withColumn(
        "row_number",
        F.col("offset") + F.row_number().over(Window.partitionBy("bucket").orderBy(*keys)) - 1,
    )
    return placed.drop("bucket", "offset"), n


def shard_rows(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document with its shard and slot under the law ``rows``, and its global row number."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    scratch = Scratch(docs.sparkSession, "shards")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias(id_col),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    numbered, n = number_rows(rows, [id_col, "text_crc32", "size"], scratch)
    place = permute(F.col("row_number"), n, seed)
    return numbered.withColumn("place", place).select(
        id_col,
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        _quotient(F.col("place"), shards).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
