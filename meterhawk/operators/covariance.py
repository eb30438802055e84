"""Robust covariance by the minimum covariance determinant (Rousseeuw & Van Driessen 1999), with deterministic
starts (Hubert, Rousseeuw & Verdonck 2012).

A concentration step keeps the share of rows with the least distances and takes their centre and covariance. A job
adds up count, sums and cross-products of the rows in each class of distances, sixteen classes to a power of two; the class
on the edge of the share and its neighbours are parted 4,096-fold. Classes and parts are taken in order until the share is
reached; rows whose distances agree to one part in 90,000 are taken together. So no quantile and no pass over single rows is
needed, and only the moments of the rows taken reach the driver. Where the edge was not foreseen, as in the first step, the
job runs once more.

Six starts come from all rows: the coordinate-wise centre, the half of the rows closest to it, and the correlations of
tanh, rank and normal scores and of spatial signs, each rescaled along its own axes by robust spreads. All advance in the same
jobs; the two tightest are run until they settle. A fit that does not settle is an error. Features may be collinear, so inverses
and determinants use the eigenvalues above a relative tolerance.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterhawk import schema as S
from meterhawk.operators.quantiles import coarse_distribution, coarse_quantiles, threshold

RANK_TOLERANCE = 1e-10
CLASSES_PER_POWER = 16
PARTS_OF_CLASS = 4_096
# Class of a distance of 0, below those of all others.
NEAREST = -(2.0**20)
RANK_CLASSES = 16
FIRST_SHARE = 0.5
EARLY_STEPS = 2
STARTS_KEPT = 2
SETTLED = 1e-9
# Each step tightens the volume, so a fit ends by itself; a fit that takes this long is an error, not a result.
MOST_STEPS = 1_000
REWEIGHT_QUANTILE = 0.975


class NoSpread(ValueError):
    """The rows span no volume, so there is no covariance to fit."""


@dataclass(frozen=True)
class Covariance:
    columns: list[str]
    location: list[float]
    precision: list[list[float]]
    threshold: float | None = None


def _spectrum(matrix: np.ndarray):
    values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
    kept = values > max(values.max(), 0.0) * RANK_TOLERANCE
    return values[kept], vectors[:, kept]


def pseudo_inverse(matrix: np.ndarray) -> np.ndarray:
    values, vectors = _spectrum(matrix)
    return (vectors / values) @ vectors.T


def log_volume(matrix: np.ndarray) -> tuple[int, float]:
    """(rank, log pseudo-determinant); smaller is tighter."""
    values, _ = _spectrum(matrix)
    return len(values), float(np.log(values).sum())


def chi_square_quantile(p: float, freedom: int) -> float:
    """Chi-square quantile by bisection on the series of the incomplete gamma function."""

    def cdf(x: float) -> float:
        a, half = freedom / 2, x / 2
        if half <= 0:
            return 0.0
        term = total = math.exp(a * math.log(half) - half - math.lgamma(a + 1))
        for k in range(1, 10_000):
            term *= half / (a + k)
            total += term
            if term < total * 1e-16:
                break
        return total

    low, high = 0.0, 10.0 * freedom + 100.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if cdf(middle) < p else (low, middle)
    return (low + high) / 2


def mahalanobis(columns: list[str], location, precision) -> Column:
    """Squared Mahalanobis distance as plain arithmetic over the columns."""
    centred = [f"({c} - {float(m)!r}D)" for c, m in zip(columns, location)]
    terms = []
    for i, a in enumerate(centred):
        for j in range(i, len(columns)):
            factor = float(precision[i][j]) * (1.0 if i == j else 2.0)
            if factor:
                terms.append(f"{factor!r}D * {a} * {centred[j]}")
    return F.expr(f"greatest({' + '.join(terms) or '0D'}, 0D)")


def _products(points: np.ndarray) -> np.ndarray:
    """Per row: one, its values, and their products in pairs; sums of these are mergeable moments."""
    rows, width = points.shape
    out = np.empty((rows, _places_of(width)))
    out[:, 0], out[:, 1 : 1 + width] = 1.0, points
    at = 1 + width
    for i in range(width):
        np.multiply(points[:, i : i + 1], points[:, i:], out=out[:, at : at + width - i])
        at += width - i
    return out


def _in_order(classes: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray]:
    """A stable order of the classes, the classes, and where each begins; numbers of 16 bits numpy sorts by radix."""
    above = classes - classes.min()
    if above.max() >> 32:
        order = np.argsort(classes, kind="stable")
    else:
        order = np.argsort((above & 0xFFFF).astype(np.uint16), kind="stable")
        order = order[np.argsort((above >> 16).astype(np.uint16)[order], kind="stable")]
    ranged = classes[order]
    first = np.flatnonzero(np.concatenate([[True], ranged[1:] != ranged[:-1]]))
    return order, ranged[first].tolist(), first


def _unpack(total: np.ndarray, width: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, mean, covariance) of added-up products."""
    n = total[0]
    mean = total[1 : 1 + width] / n
    cov = np.empty((width, width))
    i, j = np.triu_indices(width)
    cov[i, j] = cov[j, i] = total[1 + width :] / n - mean[i] * mean[j]
    return int(n), mean, cov


def _places_of(width: int) -> int:
    return 1 + width + width * (width + 1) // 2


def _add_up(df: DataFrame, names: list[str], measure: Callable[[np.ndarray], Iterator[tuple[int, np.ndarray, np.ndarray]]]) -> DataFrame:
    """Moments as (kind, class, place, total): a task adds up its rows, Spark adds up the tasks.

    ``measure`` gives, for a batch of points, (kind, class of each row, the points to add up); place counts their products.
    """
    width = _places_of(len(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            points = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            if not len(points):
                continue
            for kind, classes, seen in measure(points):
                order, found, first = _in_order(classes)
                for c, part in zip(found, np.add.reduceat(_products(seen[order]), first)):
                    held = totals.get((kind, c))
                    totals[kind, c] = part if held is None else held + part
        keys = np.array(list(totals), np.int64).reshape(-1, 2)
        columns = [np.repeat(keys[:, 0].astype(np.int32), width), np.repeat(keys[:, 1], width), np.tile(np.arange(width, dtype=np.int32), len(keys))]
        parts = np.concatenate([np.empty(0), *totals.values()])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*columns, parts)], names=["kind", "class", "place", "part"])

    parts = df.select(*names).mapInArrow(run, "kind int, class long, place int, part double")
    return parts.groupBy("kind", "class", "place").agg(F.sum("part").alias("total"))


def _collected(moments: DataFrame, width: int, *keys: str) -> dict:
    """Totals as one vector per key."""
    found: dict = {}
    for *key, place, total in moments.select(*keys, "place", "total").collect():
        found.setdefault(tuple(key), np.zeros(_places_of(width)))[place] = total
    return found


def _codes(distance: np.ndarray, near: set[int]) -> np.ndarray:
    """Ordered codes of distances: one per class, and one per part of the classes in ``near``."""
    with np.errstate(divide="ignore"):
        at = np.maximum(np.log2(distance) * CLASSES_PER_POWER, NEAREST)
    classes = np.floor(at)
    parts = np.minimum((at - classes) * PARTS_OF_CLASS, PARTS_OF_CLASS - 1).astype(np.int64)
    classes = classes.astype(np.int64)
    return classes * PARTS_OF_CLASS + np.where(np.isin(classes, list(near)), parts, 0)


def _distances(points: np.ndarray, mean: np.ndarray, precision: np.ndarray) -> np.ndarray:
    centred = points - mean
    return np.maximum(((centred @ precision) * centred).sum(axis=1), 0.0)


def _closest(df: DataFrame, names: list[str], inverses: dict[int, tuple], wanted: dict[int, int], near: dict[int, set[int]]) -> DataFrame:
    """(kind, place, total, last): moments of each start's closest rows, and the last code among them."""

    def by_code(points: np.ndarray):
        for s, (mean, precision) in inverses.items():
            yield s, _codes(_distances(points, mean, precision), near[s]), points

    limit = F.lit(0)
    for s, n in wanted.items():
        limit = F.when(F.col("kind") == s, F.lit(n)).otherwise(limit)
    before = Window.partitionBy("kind").orderBy("class").rangeBetween(Window.unboundedPreceding, -1)
    rows = F.coalesce(F.sum(F.when(F.col("place") == 0, F.col("total"))).over(before), F.lit(0.0))
    inside = _add_up(df, names, by_code).withColumn("before", rows).where(F.col("before") < limit)
    return inside.groupBy("kind", "place").agg(F.sum("total").alias("total"), F.max("class").alias("last"))


def _advance(
    df: DataFrame, names: list[str], states: dict[int, tuple], shares: dict[int, float], rows: int, near: dict[int, set[int]] | None
) -> dict[int, tuple]:
    """One concentration step of every start: mean and covariance of its closest rows.

    ``near`` has the classes in which each start's edge is expected, and is brought up to date. Without it the class on the edge
    is taken whole, which serves to get a start on its way.
    """
    inverses = {s: (mean, pseudo_inverse(cov)) for s, (mean, cov) in states.items()}
    open_ = dict(inverses)
    found: dict[int, tuple] = {}
    foreseen = {} if near is None else near
    while open_:
        wanted = {s: math.floor(shares[s] * (rows - 1)) + 1 for s in open_}
        found_rows = _closest(df, names, open_, wanted, {s: foreseen.get(s, set()) for s in open_}).collect()
        for s in list(open_):
            mine = [r for r in found_rows if r["kind"] == s]
            moments = np.zeros(_places_of(len(names)))
            for r in mine:
                moments[r["place"]] = r["total"]
            edge = mine[0]["last"] // PARTS_OF_CLASS
            if near is None or edge in near.get(s, set()) or round(moments[0]) == wanted[s]:
                found[s] = _unpack(moments, len(names))[1:]
                del open_[s]
            foreseen[s] = {edge - 1, edge, edge + 1}
    return found


KINDS = ("tanh", "rank", "normal", "sign")


def _transforms(points: np.ndarray, knots: list[np.ndarray], normal: np.ndarray) -> list[np.ndarray]:
    """The points as seen by each of ``KINDS``."""
    ranks = np.column_stack([np.searchsorted(k, points[:, j], side="left") for j, k in enumerate(knots)])
    length = np.linalg.norm(points, axis=1, keepdims=True)
    sign = np.divide(points, length, out=np.zeros_like(points), where=length > 0)
    return [np.tanh(points), ranks.astype(np.float64), normal[ranks], sign]


def _starts(df: DataFrame, names: list[str], distributions: dict) -> dict[int, tuple]:
    """Centres and covariances to start from; ``df`` has standardised columns."""
    width = len(names)
    plain = (np.zeros(width), np.eye(width))
    knots = [coarse_quantiles(distributions[c], [k / RANK_CLASSES for k in range(1, RANK_CLASSES)]) for c in names]
    normal = np.array([NormalDist().inv_cdf((k + 0.5) / RANK_CLASSES) for k in range(RANK_CLASSES)])

    def by_kind(points: np.ndarray):
        for kind, seen in enumerate(_transforms(points, knots, normal)):
            yield kind, np.zeros(len(seen), np.int64), seen

    axes, turned = {}, []
    for (number,), moments in sorted(_collected(_add_up(df, names, by_kind), width, "kind").items()):
        kind = KINDS[number]
        cov = _unpack(moments, width)[2]
        spread = np.sqrt(np.where(np.diag(cov) > 0, np.diag(cov), 1.0))
        shape = cov if kind == "sign" else cov / np.outer(spread, spread)
        axes[kind] = np.linalg.eigh(shape)[1]
        for j, axis in enumerate(axes[kind].T):
            along = sum((F.col(c) * float(a) for c, a in zip(names, axis)), F.lit(0.0))
            turned.append(along.alias(f"{kind}{j}"))
    found = coarse_distribution(df.select(*turned), [f"{k}{j}" for k in axes for j in range(width)])
    starts = [plain, plain]
    for kind, vectors in axes.items():
        quartiles = np.array([coarse_quantiles(found[f"{kind}{j}"], [0.25, 0.5, 0.75]) for j in range(width)])
        spread = (quartiles[:, 2] - quartiles[:, 0]) ** 2
        starts.append((vectors @ quartiles[:, 1], (vectors * spread) @ vectors.T))
    return dict(enumerate(starts))


def fit_covariance(
    df: DataFrame,
    columns: list[str] = S.COVARIANCE_FEATURES,
    support: float = S.COVARIANCE_SUPPORT,
    quantile: float = S.DISTANCE_QUANTILE,
) -> Covariance:
    """Fit on the rows without null or NaN; raises ``NoSpread`` when the supported rows have no spread, and
    ``RuntimeError`` when the fit does not settle."""
    df = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    distributions = coarse_distribution(df, columns)
    rows = int(distributions[columns[0]][2].sum())
    if rows <= len(columns):
        raise NoSpread(f"{rows} rows are too few for {len(columns)} features")
    quartiles = np.array([coarse_quantiles(distributions[c], [0.25, 0.5, 0.75]) for c in columns])
    centre, spread = quartiles[:, 1], quartiles[:, 2] - quartiles[:, 0]
    spread = np.where(spread > 0, spread, 1.0)
    standard = {c: tuple((edge - m) / w for edge in distributions[c][:2]) + (distributions[c][2],) for c, m, w in zip(columns, centre, spread)}
    df = df.select(*[((F.col(c) - float(m)) / float(w)).alias(c) for c, m, w in zip(columns, centre, spread)])
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        mean, cov, cut = _fit(df, columns, _starts(df, columns, standard), support, quantile, rows)
    finally:
        df.unpersist()
    return Covariance(list(columns), (centre + spread * mean).tolist(), (pseudo_inverse(cov) / np.outer(spread, spread)).tolist(), cut)


def _has_spread(cov: np.ndarray) -> bool:
    return not np.allclose(cov, 0.0)


def _settle(df: DataFrame, names: list[str], states: dict[int, tuple], support: float, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Run the tightest starts until none changes any more; the tightest of them."""
    near: dict[int, set[int]] = {}
    states = _advance(df, names, states, {s: support if s == 0 else FIRST_SHARE for s in states}, rows, None)
    volumes: dict[int, tuple[int, float]] = {}
    done: dict[int, tuple] = {}
    for step in range(MOST_STEPS):
        states = {s: m for s, m in states.items() if _has_spread(m[1])}
        if not states:
            break
        states = _advance(df, names, states, {s: support for s in states}, rows, near if step >= EARLY_STEPS else None)
        for s, (mean, cov) in states.items():
            if not _has_spread(cov):
                continue
            volume = log_volume(cov)
            if step > EARLY_STEPS and s in volumes and volume[0] == volumes[s][0] and volumes[s][1] - volume[1] <= SETTLED:
                done[s] = (mean, cov)
            volumes[s] = volume
        if step + 1 == EARLY_STEPS:
            # Starts that have met go on as one.
            apart = {(v[0], round(v[1], 6)): s for s, v in sorted(volumes.items(), reverse=True)}
            states = {s: states[s] for _, s in sorted(apart.items())[:STARTS_KEPT]}
        states = {s: m for s, m in states.items() if s not in done}
    else:
        raise RuntimeError(f"the covariance did not settle in {MOST_STEPS} steps")
    if not done:
        raise NoSpread("the supported rows have no spread")
    return min(done.values(), key=lambda m: log_volume(m[1]))


def _fit(df: DataFrame, names: list[str], starts: dict[int, tuple], support: float, quantile: float, rows: int) -> tuple[np.ndarray, np.ndarray, float]:
    mean, cov = _settle(df, names, starts, support, rows)

    # Consistency at the normal model, then one reweighting over the rows that look regular.
    distance = mahalanobis(names, mean, pseudo_inverse(cov))
    factor = threshold(df.select(distance.alias("d")), "d", 0.5) / chi_square_quantile(0.5, len(names))
    bound = chi_square_quantile(REWEIGHT_QUANTILE, len(names)) * factor if factor > 0 else math.inf
    kept = _add_up(df.where(distance <= F.lit(bound)), names, lambda points: [(0, np.zeros(len(points), np.int64), points)])
    for moments in _collected(kept, len(names), "kind").values():
        if moments[0] > len(names):
            _, mean, cov = _unpack(moments, len(names))
    cut = threshold(df.select(mahalanobis(names, mean, pseudo_inverse(cov)).alias("d")), "d", quantile)
    return mean, cov, cut


def score_covariance(df: DataFrame, model: Covariance, columns: list[str] | None = None) -> DataFrame:
    """Add ``mah_distance`` and ``mcd_flag`` (beyond the training threshold)."""
    scored = df.withColumn("mah_distance", mahalanobis(columns or model.columns, model.location, model.precision))
    return scored.withColumn("mcd_flag", (F.col("mah_distance") > F.lit(model.threshold)).cast("int"))
