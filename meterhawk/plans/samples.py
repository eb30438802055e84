"""Trip and result tables derived from the ``events`` table, for the registered queries.

Each derived table is written once per session to the shared folder and read from there, as a trip
feed or a result table would be. Scores and flags are plain arithmetic on the trip, so a report over
them has an exact answer whatever model is trained.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterhawk.functions import rules
from meterhawk.operators.features import flagged_stream_features, split, stream_features
from meterhawk.plans.labeling import _features
from meterhawk.session import stage
from meterhawk.sources.events import fleet_file, read_event_trips
from meterhawk.sources.files import exists
from meterhawk.sources.trips import merge_fleets, project_labels

ROWS_PER_BATCH = 100
SMALL_INPUT_ROWS = 5_000_000

_staged: dict[tuple[str, str, str], tuple] = {}


def _table(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _staged or not exists(spark, _staged[key][1]):
        df, path = stage(build(), name)
        _staged[key] = (df.schema, path)
    schema, path = _staged[key]
    return spark.read.schema(schema).parquet(path)


def _derive_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small input often is one file; spread it so that all cores work on it."""
    df = read_event_trips(spark, sf_dir)
    small = df.count() <= SMALL_INPUT_ROWS
    return df.repartition(spark.sparkContext.defaultParallelism, "trip_id") if small else df


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "trips", lambda: _derive_trips(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_features(trips(spark, sf_dir))


def batch_id() -> Column:
    return F.floor(F.col("trip_id") / ROWS_PER_BATCH).cast("long")


def _scores(df: DataFrame) -> DataFrame:
    capped = F.floor(F.least(F.col("fare_per_mile"), F.lit(100.0)) * F.lit(100.0)).cast("double") / F.lit(10000.0)
    odd = rules.violates() | (F.col("trip_id") % 29 == 0)
    return df.withColumns(
        {
            "anomaly_score": capped,
            "if_score": capped - F.lit(0.0625),
            "mah_distance": F.floor(F.col("avg_speed_kmh") * F.lit(8.0)).cast("double") / F.lit(8.0),
            "if_flag": (F.col("trip_id") % 7 == 0).cast("int"),
            "mcd_flag": (F.col("trip_id") % 5 == 0).cast("int"),
            "is_anomaly": odd.cast("int"),
            "batch_id": batch_id(),
        }
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every valid trip with its features, scores, flags and (for anomalies) reason."""

    def build() -> DataFrame:
        df = _scores(features(spark, sf_dir))
        odd = F.col("is_anomaly") == 1
        return df.withColumns(
            {"reason": F.when(odd, rules.reason()), "reason_code": F.when(odd, rules.reason_code())}
        )

    return _table(spark, sf_dir, "scored_trips", build)


def results(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(normal trips, anomalous trips with reasons)."""
    anomalies, normals = split(scored(spark, sf_dir))
    return normals.drop("reason", "reason_code"), anomalies


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per batch of consecutive trips, with arithmetic stand-ins for the timings."""
    return _table(spark, sf_dir, "batch_metrics", lambda: _derive_metrics(spark, sf_dir))


def _derive_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = _scores(flagged_stream_features(trips(spark, sf_dir)))
    clean = F.count_if(F.col("is_clean"))
    found = F.count_if(F.col("is_clean") & (F.col("is_anomaly") == 1))
    counted = flagged.groupBy("batch_id").agg(
        F.count("*").alias("records_processed"), clean.alias("clean"), found.alias("anomalies_detected")
    )
    ms = F.lit(20.0) + (F.col("batch_id") * 37 % 11).cast("double") + F.col("records_processed") / F.lit(64.0)
    timed = counted.withColumn("processing_time_ms", ms)
    return timed.select(
        "batch_id",
        F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("batch_id")), "yyyy-MM-dd HH:mm:ss").alias(
            "inserted_at"
        ),
        "records_processed",
        "anomalies_detected",
        (F.col("anomalies_detected") / F.greatest("clean", F.lit(1))).alias("anomaly_rate"),
        "processing_time_ms",
        (F.col("records_processed") / (F.col("processing_time_ms") / F.lit(1000.0))).alias("throughput_eps"),
        (F.col("processing_time_ms") * F.lit(0.000016)).alias("estimated_cost_usd"),
    )


def labelled_file(spark: SparkSession, sf_dir: str, fleet: str) -> DataFrame:
    """Labelled trips of one fleet in its file layout, with an arithmetic flag as the model's vote."""
    df = _features(fleet_file(trips(spark, sf_dir), fleet), fleet)
    flag, reason = rules.label_vote(F.col("trip_id") % 41 == 0)
    return df.withColumns(
        {"is_anomaly": flag, "ai_anomaly_score": (F.col("trip_id") % 100) / F.lit(100.0), "ai_reason": reason}
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        return merge_fleets(*[project_labels(labelled_file(spark, sf_dir, f), f) for f in ("yellow", "green")])

    return _table(spark, sf_dir, "labels", build)


def partial_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels without every thirteenth trip, so that some predictions find no label."""
    return labels(spark, sf_dir).filter(F.col("trip_id") % 13 != 5)
