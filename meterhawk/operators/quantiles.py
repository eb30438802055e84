"""Exact quantiles by radix selection, the same way at every size.

A double is read as an order-preserving 64-bit number. A pass counts, for every wanted order statistic, one
16-bit digit of the numbers that share the digits found so far; the counts tell the next digit. Four passes settle any
number of columns and ranks. A task sends at most one count per digit, Spark adds them up
and picks the digits, and the driver sees one row per order statistic and pass.

Null and NaN are left out, infinities take part, and -0.0 counts as 0.0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIGIT_BITS = 16
DIGITS = 1 << DIGIT_BITS
PASSES = 64 // DIGIT_BITS
# Bounds the counts a task holds: 512 KB for each pair of a column and the digits found so far.
SLOTS_PER_PASS = 128

_SIGN = np.uint64(1 << 63)


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the doubles (no NaN)."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def ordered_values(bits: np.ndarray) -> np.ndarray:
    """The doubles of ordered bits."""
    bits = np.asarray(bits, np.uint64)
    return np.where(bits & _SIGN, bits ^ _SIGN, ~bits).view(np.float64)


@dataclass
class _Target:
    """An order statistic: ``rank`` counts within the numbers that start with ``prefix``."""

    column: int
    prob: float
    upper: bool
    prefix: int = 0
    rank: int | None = None
    position: float = 0.0


def _count_digits(slots: list[tuple[int, int]], done: int):
    """Counts of the next digit of every slot: a column and the ``done`` digits its numbers start with."""
    wanted = sorted({column for column, _ in slots})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(slots), DIGITS), np.int64)
        shift = np.uint64(64 - DIGIT_BITS * (done + 1))
        for batch in batches:
            for column in wanted:
                values = batch.column(column).to_numpy(zero_copy_only=False)
                bits = ordered_bits(values[~np.isnan(values)]) >> shift
                heads = bits >> np.uint64(DIGIT_BITS)
                digits = (bits & np.uint64(DIGITS - 1)).astype(np.int64)
                for n, (owner, prefix) in enumerate(slots):
                    if owner == column:
                        # The first digit has nothing before it.
                        mine = digits[heads == np.uint64(prefix)] if done else digits
                        counts[n] += np.bincount(mine, minlength=DIGITS)
        slot, digit = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot, pa.int32()), pa.array(digit, pa.int32()), pa.array(counts[slot, digit])], names=["slot", "digit", "held"]
        )

    return run


def digit_counts(df: DataFrame, columns: list[str], slots: list[tuple[int, int]], done: int) -> DataFrame:
    """(slot, digit, held) of ``columns``; slots are (place of the column, the ``done`` digits before)."""
    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    counted = rows.mapInArrow(_count_digits(slots, done), "slot int, digit int, held long")
    return counted.groupBy("slot", "digit").agg(F.sum("held").alias("held"))


def _narrow(df: DataFrame, columns: list[str], targets: list[_Target], done: int) -> list[_Target]:
    """The targets with one more digit; targets of empty columns fall away."""
    slots = sorted({(t.column, t.prefix) for t in targets})
    number = {slot: n for n, slot in enumerate(slots)}
    by_digit = Window.partitionBy("slot").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    counts = digit_counts(df, columns, slots, done).select(
        "slot", "digit", "held", F.coalesce(F.sum("held").over(by_digit), F.lit(0)).alias("below"),
        F.sum("held").over(Window.partitionBy("slot")).alias("n"),
    )

    def holds(t: _Target) -> str:
        position = f"{t.prob!r}D * (n - 1)"
        rank = t.rank if t.rank is not None else f"ceil({position})" if t.upper else f"floor({position})"
        return f"(slot = {number[t.column, t.prefix]} AND below <= {rank} AND {rank} < below + held)"

    found: dict[int, list] = {}
    # At most one digit per target.
    for r in counts.where(" OR ".join(sorted(set(map(holds, targets))))).collect():
        found.setdefault(r["slot"], []).append(r)
    out = []
    for t in targets:
        for r in found.get(number[t.column, t.prefix], []):
            position = t.position if done else t.prob * (r["n"] - 1)
            rank = t.rank if t.rank is not None else math.ceil(position) if t.upper else math.floor(position)
            if r["below"] <= rank < r["below"] + r["held"]:
                out.append(_Target(t.column, t.prob, t.upper, t.prefix << DIGIT_BITS | r["digit"], rank - r["below"], position))
    return out


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each column, nulls and NaN left out. ``df`` is read four times."""
    found: dict[tuple[int, float, bool], _Target] = {}
    group = max(1, SLOTS_PER_PASS // (2 * len(probs)))
    for first in range(0, len(columns), group):
        targets = [_Target(c, p, upper) for c in range(len(columns))[first : first + group] for p in sorted(set(probs)) for upper in (False, True)]
        for done in range(PASSES):
            targets = _narrow(df, columns, targets, done) if targets else []
        found.update({(t.column, t.prob, t.upper): t for t in targets})

    def value(column: int, prob: float) -> float | None:
        if (column, prob, False) not in found:
            return None
        low, high = (found[column, prob, upper] for upper in (False, True))
        a, b = (float(ordered_values(np.array([t.prefix], np.uint64))[0]) for t in (low, high))
        return a if a == b else a + (b - a) * (low.position - math.floor(low.position))

    return {c: [value(i, p) for p in probs] for i, c in enumerate(columns)}


def medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    return {c: q[0] for c, q in exact_quantiles(df, columns, [0.5]).items()}


def threshold(df: DataFrame, column: str, q: float) -> float | None:
    return exact_quantiles(df, [column], [q])[column][0]


def coarse_distribution(df: DataFrame, columns: list[str]) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(lower edges, upper edges, counts) of each column by the first digit, which parts doubles at every sixteenth of
    a power of two: one pass, exact counts, at most ``DIGITS`` classes a column."""
    slots = [(i, 0) for i in range(len(columns))]
    out: dict[str, tuple[list, list]] = {c: ([], []) for c in columns}
    for first in range(0, len(slots), SLOTS_PER_PASS):
        some = slots[first : first + SLOTS_PER_PASS]
        for r in digit_counts(df, columns, some, 0).orderBy("slot", "digit").collect():
            digits, counts = out[columns[some[r["slot"]][0]]]
            digits.append(r["digit"])
            counts.append(r["held"])
    result = {}
    for c, (digits, counts) in out.items():
        low = np.array(digits, np.uint64) << np.uint64(64 - DIGIT_BITS)
        high = low + np.uint64((1 << (64 - DIGIT_BITS)) - 1)
        result[c] = (ordered_values(low), ordered_values(high), np.array(counts, np.int64))
    return result


def coarse_quantiles(distribution: tuple[np.ndarray, np.ndarray, np.ndarray], probs: list[float]) -> np.ndarray:
    """Quantiles interpolated inside the classes of a coarse distribution."""
    low, high, counts = distribution
    ends = np.cumsum(counts)
    at = np.asarray(probs) * ends[-1]
    place = np.minimum(np.searchsorted(ends, at, side="left"), len(ends) - 1)
    share = np.clip((at - (ends[place] - counts[place])) / counts[place], 0.0, 1.0)
    return low[place] + (high[place] - low[place]) * share
