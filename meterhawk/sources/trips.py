"""Trip and label files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterhawk import schema as S
from meterhawk.sources.files import exists

MEASURES = ["passenger_count", "trip_distance", "fare_amount"]


def time_columns(fleet: str | None) -> dict[str, str]:
    """Source name to logical name of the two datetimes. Files without a fleet use the yellow names."""
    prefix = S.FLEET_PREFIX[fleet or "yellow"]
    return {f"{prefix}_{end}_datetime": f"{end}_datetime" for end in ("pickup", "dropoff")}


def detect_fleet(df: DataFrame) -> str:
    """Fleet whose datetime names the frame carries."""
    for fleet, prefix in S.FLEET_PREFIX.items():
        if f"{prefix}_pickup_datetime" in df.columns:
            return fleet
    raise ValueError("no known pickup datetime column")


def normalise_names(df: DataFrame, fleet: str | None = None) -> DataFrame:
    return df.withColumnsRenamed(time_columns(fleet or detect_fleet(df)))


def tag_fleet(df: DataFrame, fleet: str) -> DataFrame:
    return df.withColumn("taxi_type", F.lit(fleet))


def project_source(df: DataFrame, fleet: str | None) -> DataFrame:
    """The six columns the stream needs, under logical names, with the fleet when it is known."""
    kept = df.select("VendorID", *time_columns(fleet), *MEASURES)
    kept = normalise_names(kept, fleet or "yellow")
    return tag_fleet(kept, fleet) if fleet else kept


def stringify_times(df: DataFrame) -> DataFrame:
    """Datetimes as text; a missing one becomes 'NaT', as the producers of this feed write it."""
    return df.withColumns(
        {
            c: F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("NaT"))
            for c in ("pickup_datetime", "dropoff_datetime")
        }
    )


def zero_fill(df: DataFrame) -> DataFrame:
    """Null and NaN numbers become 0."""
    return df.fillna(0)


def read_trips(
    spark: SparkSession, path: str | list[str], fleet: str | None, columns: str | None = "stream"
) -> DataFrame:
    """Scan trip Parquet: the six stream columns, or every column with ``columns=None``.

    The full-width scan adds ``_row_source`` and ``_row_pos``, which identify a row whatever the
    partitioning, so that sampling by hash is repeatable and equal copies are told apart.
    """
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    if columns == "stream":
        return project_source(df, fleet)
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_row_source"),
        F.col("_metadata.row_index").alias("_row_pos"),
    )


def read_labels(spark: SparkSession, paths: dict[str, str]) -> DataFrame | None:
    """Labelled files per fleet, six columns each; missing files are skipped, null when none is left."""
    frames = [
        project_labels(read_trips(spark, path, fleet, columns=None), fleet)
        for fleet, path in paths.items()
        if exists(spark, path)
    ]
    return merge_fleets(*frames) if frames else None


def project_labels(df: DataFrame, fleet: str) -> DataFrame:
    pickup = f"{S.FLEET_PREFIX[fleet]}_pickup_datetime"
    order = [c for c in ("_row_source", "_row_pos", "trip_id") if c in df.columns]
    return df.select(
        F.lit(fleet).alias("taxi_type"),
        F.col(pickup).alias("pickup_datetime"),
        "trip_distance",
        "fare_amount",
        "is_anomaly",
        "ai_anomaly_score",
        "ai_reason",
        *order,
    )


def merge_fleets(*frames: DataFrame) -> DataFrame:
    """Several fleets as one frame."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first
