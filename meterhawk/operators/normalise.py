"""Min-max scaling and score combination.

Extremes are scalar subqueries: one small aggregate whose single row Spark inlines, with no join and
no window over the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterhawk import schema as S


def extremes(df: DataFrame, *columns: str) -> Column:
    """Struct of ``<column>_min`` and ``<column>_max`` as a scalar subquery."""
    stats = df.agg(
        *[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    )
    return stats.select(F.struct("*")).scalar()


def unit_range(value: Column, low: Column, high: Column) -> Column:
    return (value - low) / (high - low + F.lit(S.SCORE_GUARD))


def min_max(df: DataFrame, column: str, output: str) -> DataFrame:
    """Scale a column to [0, 1] over the whole frame, guarded against a zero range."""
    spanned = df.withColumn("_span", extremes(df, column))
    low, high = F.col(f"_span.{column}_min"), F.col(f"_span.{column}_max")
    return spanned.withColumn(output, unit_range(F.col(column), low, high)).drop("_span")


def normalise_global(df: DataFrame, column: str = "if_score", output: str = "ai_anomaly_score") -> DataFrame:
    """Score in [0, 1] over the whole input, 1 for the most anomalous row."""
    return min_max(df, column, output)


def combined_score(
    bounds: dict[str, float] | Column, forest: str = "if_score", distance: str = "mah_distance"
) -> Column:
    """Weighted sum of both normalised detector scores, for given extremes."""

    def scaled(column: str) -> Column:
        low, high = bounds[f"{column}_min"], bounds[f"{column}_max"]
        return unit_range(F.col(column), *[v if isinstance(v, Column) else F.lit(v) for v in (low, high)])

    return F.lit(S.FOREST_SHARE) * scaled(forest) + F.lit(S.DISTANCE_SHARE) * scaled(distance)


def combine_scores(df: DataFrame, forest: str = "if_score", distance: str = "mah_distance") -> DataFrame:
    """Add ``anomaly_score``, normalised within the frame."""
    spanned = df.withColumn("_span", extremes(df, forest, distance))
    return spanned.withColumn("anomaly_score", combined_score(F.col("_span"), forest, distance)).drop("_span")
