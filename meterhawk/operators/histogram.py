"""Equal-width histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterhawk.operators.normalise import extremes

FINE_BINS = 40


def histogram(df: DataFrame, column: str, bins: int = 10, by: list[str] | None = None) -> DataFrame:
    """Counts per bin between the column's extremes, the last bin closed.

    The bins are common to all groups of ``by``, and every group has all of them, empty ones with 0 rows. A
    column with one value gives one row with ``bin`` 0 and both edges at that value; one without values gives no
    row. The frame is read twice (extremes, counts), so stage one that is costly to compute.
    """
    df = df.filter(F.col(column).isNotNull()).select(*(by or []), F.col(column).alias("_x"))
    spanned = df.withColumn("_span", extremes(df, "_x"))
    low = F.col("_span._x_min")
    width = (F.col("_span._x_max") - low) / F.lit(float(bins))
    place = F.floor(F.try_divide(F.col("_x") - low, width))
    slot = F.when(width > 0, F.least(place, F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    binned = spanned.select(*(by or []), slot.alias("bin"), low.alias("_low"), width.alias("_width"))
    counted = binned.groupBy(*(by or []), "bin", "_low", "_width").agg(F.count("*").alias("rows"))
    # At most ``bins`` entries per group.
    held = counted.groupBy(*(by or []), "_low", "_width").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "rows"))).alias("_held")
    )
    last = F.when(F.col("_width") > 0, F.lit(bins - 1)).otherwise(F.lit(0))
    every = held.withColumn("bin", F.explode(F.sequence(F.lit(0), last)))
    edges = {"low": F.col("_low") + F.col("_width") * F.col("bin"), "high": F.col("_low") + F.col("_width") * (F.col("bin") + 1)}
    rows = F.coalesce(F.try_element_at("_held", F.col("bin")), F.lit(0).cast("long")).alias("rows")
    return every.withColumns(edges).select(*(by or []), "bin", "low", "high", rows)


def histogram_by(df: DataFrame, column: str, by: str, bins: int = FINE_BINS) -> DataFrame:
    return histogram(df, column, bins, [by])
