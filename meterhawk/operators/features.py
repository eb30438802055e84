"""Feature engineering and the filters around it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterhawk import schema as S
from meterhawk.functions import trips as X

BASE_FLOATS = {"trip_distance", "fare_amount", "avg_speed_kmh", "fare_per_mile", "passenger_count"}


def time_features(df: DataFrame) -> DataFrame:
    """Add ``trip_duration_sec`` and ``pickup_hour`` from datetime texts or timestamps."""
    pickup, dropoff = (
        F.col(c) if dict(df.dtypes)[c].startswith("timestamp") else X.parse_time(c)
        for c in ("pickup_datetime", "dropoff_datetime")
    )
    return df.withColumns(
        {"trip_duration_sec": X.trip_duration(pickup, dropoff), "pickup_hour": X.pickup_hour(pickup)}
    )


def ratio_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "avg_speed_kmh": X.avg_speed("trip_distance", "trip_duration_sec"),
            "fare_per_mile": X.fare_per_mile("fare_amount", "trip_distance"),
        }
    )


def derived_features(df: DataFrame, clamp: bool = False) -> DataFrame:
    """Cyclic hour, logs, interaction, ratio and context flags."""
    return df.withColumns(
        {
            "hour_sin": X.hour_sin("pickup_hour"),
            "hour_cos": X.hour_cos("pickup_hour"),
            "speed_x_duration": X.speed_x_duration("avg_speed_kmh", "trip_duration_sec"),
            "log_distance": X.log_feature("trip_distance", clamp),
            "log_fare": X.log_feature("fare_amount", clamp),
            "is_rush_hour": X.rush_hour("pickup_hour"),
            "is_night": X.night("pickup_hour"),
            "fare_distance_ratio": X.fare_distance_ratio("fare_amount", "trip_distance"),
        }
    )


def valid_trips(df: DataFrame) -> DataFrame:
    return df.filter(X.valid_trip())


def drop_missing(df: DataFrame, columns: list[str] = S.BASE_FEATURES) -> DataFrame:
    return df.dropna(subset=columns)


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.dropna()


def is_clean() -> Column:
    """The validity filter and the completeness check as one flag (null-safe)."""
    return F.coalesce(X.valid_trip() & X.complete(S.BASE_FEATURES, BASE_FLOATS), F.lit(False))


def stream_features(df: DataFrame) -> DataFrame:
    """Every model feature for valid, complete trips. The filters run before the ratios."""
    kept = drop_missing(ratio_features(valid_trips(time_features(df))))
    return derived_features(kept)


def flagged_stream_features(df: DataFrame) -> DataFrame:
    """As ``stream_features`` but keeps every row and marks the clean ones in ``is_clean``.

    Used ahead of ``foreachBatch``, where the raw row count is needed too.
    """
    return derived_features(ratio_features(time_features(df)).withColumn("is_clean", is_clean()))


def batch_features(df: DataFrame) -> DataFrame:
    """Features of full historical data: no row is dropped, denominators carry an epsilon."""
    eps = S.BATCH_EPSILON
    df = df.withColumns({c: X.nan_to_null(F.col(c).cast("double")) for c in ("trip_distance", "fare_amount", "passenger_count")})
    df = df.withColumns(
        {
            "trip_duration_sec": X.trip_duration_exact("pickup_datetime", "dropoff_datetime"),
            "pickup_hour": X.pickup_hour("pickup_datetime"),
        }
    )
    df = df.withColumns(
        {
            "avg_speed_kmh": X.avg_speed("trip_distance", "trip_duration_sec", eps),
            "fare_per_mile": X.fare_per_mile("fare_amount", "trip_distance", eps),
        }
    )
    return derived_features(df, clamp=True)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def for_fleet(df: DataFrame, fleet: str = "All") -> DataFrame:
    return df if fleet.lower() == "all" else df.filter(F.col("taxi_type") == fleet.lower())


def split(df: DataFrame, flag: str = "is_anomaly") -> tuple[DataFrame, DataFrame]:
    """(anomalies, normals) of one scored frame."""
    return df.filter(F.col(flag) == 1), df.filter(F.col(flag) == 0)
