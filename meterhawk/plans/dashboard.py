"""Fleet and system reports over the result tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterhawk import schema as S
from meterhawk.functions.trips import fixed

FEEDS = {
    "live": ["taxi_type", "VendorID", "pickup_datetime", "trip_distance", "fare_amount", "avg_speed_kmh", "anomaly_score"],
    "anomaly_log": ["taxi_type", "pickup_datetime", "trip_distance", "fare_amount", "avg_speed_kmh", "anomaly_score", "reason"],
    "speed_distance": ["trip_distance", "avg_speed_kmh", "taxi_type", "fare_amount"],
    "fare_duration": ["trip_duration_sec", "fare_amount", "taxi_type"],
}
METRIC_COLUMNS = [
    "batch_id",
    "inserted_at",
    "processing_time_ms",
    "throughput_eps",
    "estimated_cost_usd",
    "records_processed",
    "anomalies_detected",
    "anomaly_rate",
]


def normal_by_fleet(normals: DataFrame) -> DataFrame:
    return normals.groupBy("taxi_type").agg(
        F.count("*").alias("total_normal"), F.avg("fare_amount").alias("avg_fare")
    )


def anomalies_by_fleet(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy("taxi_type").agg(F.count("*").alias("total_anomalies"))


def fleets(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([(f,) for f in S.FLEETS], "taxi_type string")


def fleet_summary(normals: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Counts, mean fare and anomaly share, 0 where a fleet has no rows.

    Every known fleet has a row, and so has every other name in the data, the null name included.
    """
    parts = [normal_by_fleet(normals), anomalies_by_fleet(anomalies), fleets(normals)]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    full = every.groupBy("taxi_type").agg(
        *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("total_normal", "avg_fare", "total_anomalies")]
    )
    total = F.col("total_normal") + F.col("total_anomalies")
    return full.withColumn("anomaly_share", F.col("total_anomalies") / F.nullif(total, F.lit(0)))


def anomaly_share(normals: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Anomalies as a share of all stored trips per fleet; null for a fleet without trips."""
    return fleet_summary(normals, anomalies).select("taxi_type", "anomaly_share")


def kpi_format(summary: DataFrame) -> DataFrame:
    """Fleet figures as shown: fare to cents, share in percent to one decimal."""
    return summary.select(
        "taxi_type",
        F.round("avg_fare", 2).alias("avg_fare"),
        F.round(F.col("anomaly_share") * 100, 1).alias("anomaly_percent"),
    )


def system_kpis(metrics: DataFrame, n: int = S.RECENT_BATCHES) -> DataFrame:
    """The newest throughput and latency and the recent totals, as shown."""
    newest = F.struct("inserted_at", "batch_id")
    row = recent_metrics(metrics, n).agg(
        F.max_by("throughput_eps", newest).alias("throughput"),
        F.max_by("processing_time_ms", newest).alias("latency"),
        F.sum("records_processed").alias("records"),
        F.sum("estimated_cost_usd").alias("cost"),
    )
    return row.select(
        F.format_number("throughput", 0).alias("throughput"),
        F.concat(F.format_number("latency", 0), F.lit(" ms")).alias("latency"),
        F.format_number("records", 0).alias("records"),
        F.concat(F.lit("$"), fixed("cost", 4)).alias("cost"),
    )


def latest(df: DataFrame, order: list[str | Column], n: int = S.LATEST_TRIPS) -> DataFrame:
    """The newest rows; ``order`` is the arrival order, oldest first, without ties."""
    return df.orderBy(*[F.desc(c) if isinstance(c, str) else c for c in order]).limit(n)


def feed_columns(df: DataFrame, kind: str) -> DataFrame:
    return df.select(*FEEDS[kind])


def live_feed(normals: DataFrame, order: list[str], n: int = S.LIVE_TRIPS) -> DataFrame:
    return feed_columns(latest(normals, order, n), "live")


def recent_metrics(metrics: DataFrame, n: int = S.RECENT_BATCHES) -> DataFrame:
    return latest(metrics, ["inserted_at", "batch_id"], n).select(*METRIC_COLUMNS)


def recent_totals(metrics: DataFrame, n: int = S.RECENT_BATCHES) -> DataFrame:
    """Records and cost of the newest batches."""
    return recent_metrics(metrics, n).agg(
        F.sum("records_processed").alias("records"), F.sum("estimated_cost_usd").alias("cost_usd")
    )


def current_value(metrics: DataFrame, column: str) -> DataFrame:
    """A column's value at the newest batch."""
    return metrics.agg(F.max_by(column, F.struct("inserted_at", "batch_id")).alias(column))


def series(metrics: DataFrame, column: str, n: int = S.RECENT_BATCHES) -> DataFrame:
    """A column over the newest batches, oldest first."""
    recent = recent_metrics(metrics, n)
    return recent.orderBy("inserted_at", "batch_id").select("batch_id", "inserted_at", column)


def by_batch(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("batch_id")
