"""Isolation forest (Liu, Ting & Zhou 2008) trained and scored in parallel.

Training draws, for every tree, a weighted sample without replacement (Efraimidis & Spirakis 2006): a row's draw in a tree
is exponential with its weight as the rate, and the ``sample`` least draws are kept. All draws come from a hash of the row key, so
the result depends neither on partitioning nor on task order, and every row can enter every tree at any size. Only
draws under a bound that each tree fills by far are made: a row jumps over the trees that it does not enter. Tasks keep the least
draws of each tree, tighten the tree's bound as they go, and pack what is left into binary rows; those meet by tree, where one
task merges them and grows the tree. A tree's group is bounded by the sample size whatever the data.

A forest is one row per tree with its nodes in packed arrays, at most ``2 * sample`` nodes of 9 bytes. It is scored in
blocks of whole trees of at most ``BLOCK_BYTES`` (a larger tree is a block of its own); between blocks the rows are
written with their path sums, so neither driver nor workers hold more than a block.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterhawk import schema as S
from meterhawk.operators.quantiles import threshold
from meterhawk.session import stage
from meterhawk.sources.files import delete

FOREST_SCHEMA = (
    "tree int, sample_rows int, depth int, nodes int, feature binary, value binary, child binary"
)
PACKED_SCHEMA = "tree int, block binary"
NODE_BYTES = 9
BLOCK_BYTES = 128 << 20
# Rows of partial samples that a task holds before it sends them on.
HELD_BYTES = 64 << 20
SMALL_INPUT_ROWS = 5_000_000
BOUND_STEPS = 24
# Rows walked at a time, so that what a step reads and writes stays in the cache.
WALK_ROWS = 16_384

_MIX = [np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)]


def average_path(size):
    """Mean path length of an unsuccessful search among ``size`` points."""
    size = np.asarray(size, dtype=np.float64)
    many = np.maximum(size, 3.0)
    path = 2.0 * (np.log(many - 1.0) + np.euler_gamma) - 2.0 * (many - 1.0) / many
    return np.where(size <= 1, 0.0, np.where(size == 2, 1.0, path))


def uniforms(keys: np.ndarray, salt: int) -> np.ndarray:
    """Uniforms in (0, 1) from 64-bit keys, one independent stream per salt."""
    with np.errstate(over="ignore"):
        z = keys ^ (np.uint64(salt + 1) * _MIX[2])
        for shift, factor in ((30, _MIX[0]), (27, _MIX[1])):
            z = (z ^ (z >> np.uint64(shift))) * factor
        z ^= z >> np.uint64(31)
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def _draw_bound(base: DataFrame, rows: int, weights: float, wanted: float) -> float:
    """Bound under which at least ``wanted`` draws of a tree are expected, and at most about twice as many.

    Under a bound ``b`` a row has a draw with probability ``1 - exp(-weight * b)``; their sum is concave in ``b``, so a
    straight line between two bounds stays below it. Takes one pass, whatever the weights.
    """
    if rows <= wanted:
        return math.inf
    steps = [wanted / weights * 2.0**k for k in range(BOUND_STEPS)]
    sums = base.agg(*[F.sum(-F.expm1(-F.col("_weight") * F.lit(b))) for b in steps]).first()
    low, below = 0.0, 0.0
    for b, found in zip(steps, sums):
        if found >= wanted:
            return low + (b - low) * (wanted - below) / (found - below)
        low, below = b, found
    return math.inf


def draws(keys: np.ndarray, weights: np.ndarray, bound: float, trees: int, salt: int):
    """Yield (rows, trees, draws) of all draws up to ``bound``, a jump of every row at a time.

    The trees a row enters are independent events of one probability, so the gaps between them are geometric; a draw that
    is known to be in the bound follows the exponential cut off there.
    """
    chance = -np.expm1(-weights * bound) if bound != math.inf else np.where(weights > 0, 1.0, 0.0)
    rows = np.flatnonzero(chance > 0)
    tree = np.full(len(rows), -1, np.int64)
    with np.errstate(divide="ignore"):
        stay = np.log1p(-chance)
    jump = 0
    while len(rows):
        gap = np.floor(np.log(uniforms(keys[rows], salt + 2 * jump)) / stay[rows])
        tree = tree + 1 + np.minimum(gap, trees).astype(np.int64)
        inside = tree < trees
        rows, tree = rows[inside], tree[inside]
        share = uniforms(keys[rows], salt + 2 * jump + 1) * chance[rows]
        yield rows, tree, -np.log1p(-share) / weights[rows]
        jump += 1


class _PartialSamples:
    """The least draws of each tree among the rows a task has seen since it last sent some on."""

    def __init__(self, trees: int, sample: int, row_type: np.dtype):
        self.sample, self.row_type = sample, row_type
        self.bounds = np.full(trees, math.inf)
        self._clear()

    def _clear(self) -> None:
        self.parts: dict[int, list[np.ndarray]] = {}
        self.sizes: dict[int, int] = {}
        self.held = 0

    def add(self, rows: np.ndarray, trees: np.ndarray, found: np.ndarray, points: np.ndarray) -> None:
        keep = found <= self.bounds[trees]
        rows, trees, found = rows[keep], trees[keep], found[keep]
        # Of numbers of 16 bits numpy sorts by radix.
        order = np.argsort(trees.astype(np.uint16) if len(self.bounds) <= 1 << 16 else trees, kind="stable")
        packed = np.empty(len(rows), self.row_type)
        packed["draw"], packed["x"] = found[order], points[rows[order]]
        sizes = np.bincount(trees, minlength=len(self.bounds))
        numbers = np.flatnonzero(sizes)
        ends = np.cumsum(sizes)[numbers].tolist()
        for tree, first, last in zip(numbers.tolist(), [0, *ends], ends):
            part = packed[first:last]
            self.parts.setdefault(tree, []).append(part)
            self.sizes[tree] = self.sizes.get(tree, 0) + len(part)
            self.held += part.nbytes
            if self.sizes[tree] > 2 * self.sample + 1024:
                self._tighten(tree)

    def _tighten(self, tree: int) -> None:
        whole = np.concatenate(self.parts[tree])
        kept = whole[np.argpartition(whole["draw"], self.sample - 1)[: self.sample]] if len(whole) > self.sample else whole
        if len(kept) == self.sample:
            self.bounds[tree] = min(self.bounds[tree], float(kept["draw"].max()))
        self.held += kept.nbytes - whole.nbytes
        self.parts[tree], self.sizes[tree] = [kept], len(kept)

    def take(self) -> pd.DataFrame:
        for tree in list(self.parts):
            self._tighten(tree)
        numbers = sorted(self.parts)
        packed = pd.DataFrame({"tree": np.array(numbers, dtype=np.int32), "block": [self.parts[t][0].tobytes() for t in numbers]})
        self._clear()
        return packed


def _grow(points: np.ndarray, limit: int, rng: np.random.Generator):
    """Grow one tree level by level; all nodes of a level are split at once."""
    rows, width = points.shape
    flat = np.ascontiguousarray(points).ravel()
    order = np.arange(rows)
    sizes = np.array([rows])
    feature, value, child = [], [], []
    count, depth = 1, 0
    while sizes.size:
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        picked = np.full(sizes.size, -1, dtype=np.int64)
        low = np.zeros(sizes.size, dtype=np.float32)
        high = np.zeros(sizes.size, dtype=np.float32)
        if depth < limit:
            tries = np.argsort(rng.random((sizes.size, width)), axis=1)
            open_ = np.flatnonzero(sizes > 1)
            for attempt in range(width):
                if not open_.size:
                    break
                lengths = sizes[open_]
                begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
                at = np.repeat(starts[open_] - begin, lengths)
                at += np.arange(len(at))
                column = tries[open_, attempt]
                x = flat[order[at] * width + np.repeat(column, lengths)]
                mn, mx = np.minimum.reduceat(x, begin), np.maximum.reduceat(x, begin)
                varied = mx > mn
                done = open_[varied]
                picked[done], low[done], high[done] = column[varied], mn[varied], mx[varied]
                open_ = open_[~varied]
        inner = picked >= 0
        cut = (low + rng.random(sizes.size) * (high - low)).astype(np.float32)
        cut = np.where(cut >= high, low, cut)
        leaf_path = (depth + average_path(sizes)).astype(np.float32)
        numbers = count + 2 * (np.cumsum(inner) - 1)
        feature.append(np.where(inner, picked, -1).astype(np.int8))
        value.append(np.where(inner, cut, leaf_path).astype(np.float32))
        child.append(np.where(inner, numbers, 0).astype(np.int32))
        count += 2 * int(inner.sum())
        keep = np.repeat(inner, sizes)
        node = np.repeat(np.cumsum(inner) - 1, sizes)[keep]
        order = order[keep]
        if not order.size:
            break
        right = flat[order * width + np.repeat(picked, sizes)[keep]] > np.repeat(cut, sizes)[keep]
        slot = 2 * node + right
        sizes = np.bincount(slot, minlength=2 * int(inner.sum()))
        # The rows lie by node already, so each child's rows keep their order and only move up.
        rights = np.cumsum(right)
        first = np.cumsum(sizes) - sizes
        before = np.cumsum(sizes[1::2]) - sizes[1::2]
        nth = np.where(right, rights - 1 - before[node], np.arange(len(order)) - rights - (first[::2] - before)[node])
        moved = np.empty_like(order)
        moved[first[slot] + nth] = order
        order = moved
        depth += 1
    return depth, np.concatenate(feature), np.concatenate(value), np.concatenate(child)


def _row_type(width: int) -> np.dtype:
    return np.dtype([("draw", "<f8"), ("x", "<f4", (width,))])


def fit_forest(
    df: DataFrame,
    columns: list[str],
    key: list[Column | str],
    trees: int = S.STREAM_TREES,
    sample: int = S.STREAM_SAMPLE,
    weight: Column | None = None,
    seed: int = S.SEED,
    rows: int | None = None,
) -> DataFrame:
    """Train a forest; ``key`` identifies a row uniquely and repeatably. Returns ``FOREST_SCHEMA``.

    ``weight`` is the propensity of a row to be drawn; a row without a positive weight is never drawn. Without
    weights a known row count (``rows``) saves a pass over the input.
    """
    spark = df.sparkSession
    positive = F.lit(1.0) if weight is None else F.greatest(F.coalesce(F.nanvl(weight.cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(0.0))
    base = df.select(
        *[F.col(c).cast("float").alias(c) for c in columns],
        positive.alias("_weight"),
        F.xxhash64(*key, F.lit(seed)).alias("_key"),
    )
    if weight is None and rows is not None:
        total = float(rows)
    else:
        found = base.agg(F.count_if(F.col("_weight") > 0).alias("n"), F.sum("_weight").alias("total")).first()
        rows, total = found["n"], found["total"]
    sample = int(min(sample, rows))
    # A tree falls short of its sample with a chance of under 1 in 10 ** 14.
    margin = sample + 8 * math.sqrt(sample) + 16
    if weight is None:
        bound = -math.log1p(-margin / rows) if rows > margin else math.inf
    else:
        bound = _draw_bound(base, rows, total, margin)
    if rows <= SMALL_INPUT_ROWS:
        base = base.repartition(spark.sparkContext.defaultParallelism, "_key")
    row_type = _row_type(len(columns))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        partial = _PartialSamples(trees, sample, row_type)
        for pdf in batches:
            points = pdf[columns].to_numpy(dtype=np.float32)
            keys = pdf["_key"].to_numpy().view(np.uint64)
            for at, tree, draw in draws(keys, pdf["_weight"].to_numpy(), bound, trees, seed * 1_000_003):
                partial.add(at, tree, draw, points)
                if partial.held > HELD_BYTES:
                    yield partial.take()
        yield partial.take()

    limit = math.ceil(math.log2(max(sample, 2)))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        drawn = np.frombuffer(b"".join(pdf["block"]), dtype=row_type)
        drawn = drawn[np.argsort(drawn["draw"], kind="stable")][:sample]
        if len(drawn) < sample:
            raise RuntimeError(f"tree {tree} drew {len(drawn)} of {sample} rows; use another seed")
        rng = np.random.default_rng([seed, tree])
        depth, feature, value, child = _grow(np.ascontiguousarray(drawn["x"]), limit, rng)
        return pd.DataFrame(
            {
                "tree": [tree],
                "sample_rows": [len(drawn)],
                "depth": [depth],
                "nodes": [len(feature)],
                "feature": [feature.tobytes()],
                "value": [value.tobytes()],
                "child": [child.tobytes()],
            }
        ).astype({"tree": "int32", "sample_rows": "int32", "depth": "int32", "nodes": "int32"})

    tasks = min(trees, max(spark.sparkContext.defaultParallelism * 4, 1))
    packed = base.mapInPandas(pack, PACKED_SCHEMA).repartition(tasks, "tree")
    return packed.groupBy("tree").applyInPandas(grow, FOREST_SCHEMA)


class Block:
    """Whole trees as tasks walk them. Arrays are made ready once in a worker, which keeps the block it was sent."""

    def __init__(self, trees: list[tuple]):
        self.trees = trees  # (sample_rows, depth, feature, value, child)

    def __getstate__(self):
        return {"trees": self.trees}

    @cached_property
    def walkers(self) -> list[tuple]:
        """Per tree: depth, one word a node, leaf values. A word holds cut, left child and column, so that a step reads it once."""
        ready = []
        for _, depth, feature, value, child in self.trees:
            leaf = feature < 0
            bits = max(int(feature.max(initial=0)).bit_length(), 1)
            if len(child) >> 32 - bits:
                raise ValueError("a tree has more nodes than a word can name")
            cut = np.where(leaf, np.float32(np.inf), value).astype(np.float32)
            # A leaf is its own left child, and nothing lies beyond its cut.
            left = np.where(leaf, np.arange(len(child)), child).astype(np.int64)
            word = cut.view(np.uint32).astype(np.int64) << 32 | left << bits | np.where(leaf, 0, feature)
            ready.append((depth, bits, word, value.astype(np.float64)))
        return ready

    def paths(self, points: np.ndarray) -> np.ndarray:
        """Sum of each point's path lengths."""
        width = points.shape[1]
        total = np.zeros(len(points))
        for first in range(0, len(points), WALK_ROWS):
            flat = np.ascontiguousarray(points[first : first + WALK_ROWS]).ravel()
            rows = len(flat) // width
            base = np.arange(rows, dtype=np.int64) * width
            step = _Step(rows)
            at = np.empty(rows, np.int64)
            for depth, bits, word, value in self.walkers:
                at[:] = 0
                for _ in range(depth):
                    place = step.read(word, bits, at)
                    place += base
                    step.turn(flat, place)
                    step.move(bits, at)
                total[first : first + rows] += value[at]
        return total

    def swapped_paths(self, points: np.ndarray, donors: np.ndarray) -> np.ndarray:
        """(features + 1, rows): the sums as they are, then with each feature replaced by its donor value, one at a time.

        A row with a replaced feature takes the path of the row as it is up to the first node at which the donor value turns the
        other way, so only from there on it is walked by itself.
        """
        rows, width = points.shape
        if width > 63:
            raise ValueError("a path mask has room for 63 features")
        totals = np.zeros((width + 1, rows))
        both = np.concatenate([np.ascontiguousarray(points).ravel(), np.ascontiguousarray(donors).ravel()])
        size = rows * width
        base = np.arange(rows, dtype=np.int64) * width
        step = _Step(rows)
        at, apart, place = (np.empty(rows, np.int64) for _ in range(3))
        donor, other = np.empty(rows, np.float32), np.empty(rows, bool)
        for depth, bits, word, value in self.walkers:
            at[:], apart[:] = 0, 0
            # Rows that go by themselves: row, replaced feature, node.
            own = np.empty((3, 0), np.int64)
            for _ in range(depth):
                if own.shape[1]:
                    alone = _Step(own.shape[1])
                    column = alone.read(word, bits, own[2])
                    alone.turn(both, own[0] * width + column + np.where(column == own[1], size, 0))
                    alone.move(bits, own[2])
                column = step.read(word, bits, at)
                np.add(base, column, out=place)
                step.turn(both, place)
                place += size
                np.greater(np.take(both, place, out=donor, mode="clip"), step.cut, out=other)
                leaving = np.flatnonzero(np.not_equal(other, step.right, out=other))
                feature = column[leaving]
                first = (apart[leaving] >> feature & 1) == 0
                leaving, feature = leaving[first], feature[first]
                apart[leaving] |= np.left_shift(1, feature)
                step.move(bits, at)
                if len(leaving):
                    # The children of a node are neighbours, the right one after the left.
                    node = at[leaving] + np.where(step.right[leaving], -1, 1)
                    own = np.hstack([own, [leaving, feature, node]])
            plain = value[at]
            totals += plain
            totals[own[1] + 1, own[0]] += value[own[2]] - plain[own[0]]
        return totals


class _Step:
    """One step of many rows down a tree, in arrays that are used again."""

    def __init__(self, rows: int):
        self.node, self.place = np.empty(rows, np.int64), np.empty(rows, np.int64)
        self.cut = self.node.view(np.float32)[1 if sys.byteorder == "little" else 0 :: 2]
        self.x, self.right = np.empty(rows, np.float32), np.empty(rows, bool)

    def read(self, word: np.ndarray, bits: int, at: np.ndarray) -> np.ndarray:
        """The column that each row's node compares."""
        np.take(word, at, out=self.node, mode="clip")
        return np.bitwise_and(self.node, (1 << bits) - 1, out=self.place)

    def turn(self, values: np.ndarray, place: np.ndarray) -> None:
        np.take(values, place, out=self.x, mode="clip")
        np.greater(self.x, self.cut, out=self.right)

    def move(self, bits: int, at: np.ndarray) -> None:
        np.right_shift(self.node, bits, out=at)
        np.bitwise_and(at, (1 << 32 - bits) - 1, out=at)
        at += self.right


@dataclass(frozen=True)
class Forest:
    """A trained forest and its decision cut. ``blocks`` has (first tree, last tree) of each block of the table ``nodes``;
    a forest of one block is held and needs its table no more."""

    columns: list[str]
    nodes: DataFrame = field(compare=False, repr=False)
    blocks: list[tuple[int, int]]
    expected: float
    cut: float | None = None
    held: Block | None = field(default=None, compare=False, repr=False)
    _sent: dict = field(default_factory=dict, compare=False, repr=False)

    def block(self, number: int) -> Block:
        if self.held:
            return self.held
        first, last = self.blocks[number]
        found = self.nodes.where(F.col("tree").between(first, last)).collect()
        trees = []
        for r in sorted(found, key=lambda r: r["tree"]):
            arrays = (np.frombuffer(r[c], dtype=t) for c, t in (("feature", "i1"), ("value", "f4"), ("child", "i4")))
            trees.append((r["sample_rows"], r["depth"], *arrays))
        return Block(trees)

    @property
    def trees(self) -> list[tuple]:
        """All trees on the driver, for forests of one block."""
        if len(self.blocks) > 1:
            raise ValueError("a forest of several blocks is scored block by block")
        return self.block(0).trees if self.blocks else []

    def broadcast(self, spark: SparkSession, number: int):
        """A block as a broadcast variable. That of a forest of one block is sent once, however many frames are scored."""
        key = spark.sparkContext.applicationId
        if len(self.blocks) > 1:
            return spark.sparkContext.broadcast(self.block(number))
        if key not in self._sent:
            self._sent[key] = spark.sparkContext.broadcast(self.block(number))
        return self._sent[key]


def load_forest(nodes: DataFrame, columns: list[str], cut: float | None = None, block_bytes: int = BLOCK_BYTES) -> Forest:
    """A forest over its table, which should be a stored one, as it is read more than once."""
    sizes = nodes.select("tree", "sample_rows", "nodes").collect()
    blocks: list[list[int]] = []
    held = 0
    for r in sorted(sizes, key=lambda r: r["tree"]):
        size = r["nodes"] * NODE_BYTES
        if not blocks or held + size > block_bytes:
            blocks.append([r["tree"], r["tree"]])
            held = 0
        blocks[-1][1] = r["tree"]
        held += size
    expected = float(sum(average_path(r["sample_rows"]) for r in sizes))
    forest = Forest(list(columns), nodes, [tuple(b) for b in blocks], expected, cut)
    return replace(forest, held=forest.block(0)) if len(blocks) == 1 else forest


def _paths(sent, features: list[Column]) -> Column:
    @F.pandas_udf("double")
    def paths(*series: pd.Series) -> pd.Series:
        points = np.column_stack([f.to_numpy(dtype=np.float32) for f in series])
        return pd.Series(sent.value.paths(points))

    return paths(*features)


def add_scores(df: DataFrame, forest: Forest, output: str, columns: list[str | Column] | None = None) -> tuple[DataFrame, list[str]]:
    """``df`` with its isolation scores, ``2 ** -(mean path / expected path)``; higher is more anomalous.

    A forest of one block adds a column. Otherwise rows are written with their sums so far after every block but the last.
    Returns the frame and the folders it is read from, which may be deleted once it has been used.
    """
    spark = df.sparkSession
    given = df.columns
    features = [F.col(c).cast("float") if isinstance(c, str) else c for c in columns or forest.columns]
    if not forest.blocks or not forest.expected:
        return df.withColumn(output, F.lit(0.5)), []
    names = [f"_feature_{i}" for i in range(len(features))]
    total, paths = F.lit(0.0), []
    if len(forest.blocks) > 1:
        df = df.select("*", *[f.alias(n) for f, n in zip(features, names)])
        features = [F.col(n) for n in names]
    for number in range(len(forest.blocks)):
        total = total + _paths(forest.broadcast(spark, number), features)
        if number + 1 < len(forest.blocks):
            df, path = stage(df.withColumn("_paths", total), "paths")
            total = F.col("_paths")
            if paths:
                delete(spark, paths.pop())
            paths.append(path)
    return df.select(*given, F.pow(F.lit(2.0), -total / F.lit(forest.expected)).alias(output)), paths


def forest_score(spark: SparkSession, forest: Forest, columns: list[str | Column] | None = None) -> Column:
    """Isolation score as a column, for a forest of one block; ``add_scores`` takes any."""
    if not forest.blocks or not forest.expected:
        return F.lit(0.5)
    if len(forest.blocks) > 1:
        raise ValueError("a forest of several blocks is scored by add_scores")
    features = [F.col(c).cast("float") if isinstance(c, str) else c for c in columns or forest.columns]
    return F.pow(F.lit(2.0), -_paths(forest.broadcast(spark, 0), features) / F.lit(forest.expected))


def decision_cut(df: DataFrame, score: str, contamination: float, staged: bool = False) -> float:
    """The score that ``contamination`` of the training rows exceed.

    A quantile takes several passes, so scores still to be computed are written once first; ``staged`` says that the
    frame already reads them from storage.
    """
    path = None
    if not staged:
        df, path = stage(df.select(score), "scores")
    cut = threshold(df, score, 1.0 - contamination)
    if path:
        delete(df.sparkSession, path)
    return cut


def with_cut(forest: Forest, cut: float) -> Forest:
    return replace(forest, cut=cut)


def score_forest(df: DataFrame, forest: Forest, columns: list[str] | None = None) -> DataFrame:
    """Add ``if_score`` (score minus cut) and ``if_flag`` (above the cut)."""
    scored, _ = add_scores(df, forest, "_score", columns)
    scored = scored.withColumn("if_score", F.col("_score") - F.lit(forest.cut)).drop("_score")
    return scored.withColumn("if_flag", (F.col("if_score") > 0).cast("int"))
