"""Robust scaling and median imputation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterhawk.functions.trips import nan_to_null
from meterhawk.operators.quantiles import exact_quantiles, medians

SCALER_SCHEMA = "feature string, center double, scale double"


@dataclass(frozen=True)
class Scaler:
    """Median and interquartile range per feature; a zero range scales by 1."""

    features: list[str]
    center: list[float]
    scale: list[float]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(zip(self.features, self.center, self.scale)), SCALER_SCHEMA)


def fit_scaler(df: DataFrame, columns: list[str]) -> Scaler:
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    spans = [(quartiles[c][2] - quartiles[c][0]) if quartiles[c][1] is not None else 0.0 for c in columns]
    return Scaler(
        list(columns),
        [quartiles[c][1] if quartiles[c][1] is not None else 0.0 for c in columns],
        [span if span != 0 else 1.0 for span in spans],
    )


def scale(df: DataFrame, scaler: Scaler, prefix: str = "") -> DataFrame:
    """Centred and scaled columns; in place, or beside the originals under ``prefix``."""
    return df.withColumns(
        {
            f"{prefix}{c}": F.expr(f"(CAST({c} AS DOUBLE) - {float(center)!r}D) / {float(span)!r}D")
            for c, center, span in zip(scaler.features, scaler.center, scaler.scale)
        }
    )


def impute_median(df: DataFrame, columns: list[str], prefix: str = "") -> DataFrame:
    """Null and NaN become the column's median; in place, or beside the originals under ``prefix``."""
    fill = medians(df, columns)
    return df.withColumns(
        {
            f"{prefix}{c}": F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(fill[c]))
            for c in columns
        }
    )
