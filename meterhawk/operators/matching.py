"""Matching streamed trips with labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterhawk.functions.trips import cents

KEY = ["k_minute", "k_distance", "k_fare"]
FLEET_KEY = ["taxi_type", *KEY]
LABEL_COLUMNS = ["is_anomaly", "ai_anomaly_score", "ai_reason"]
HOT_KEYS = 10_000
HOT_ROWS = 100_000


def match_key(df: DataFrame) -> DataFrame:
    """Add the match key: pickup minute, distance and fare to two decimals."""
    return df.withColumns(
        {
            "k_minute": F.date_trunc("minute", F.col("pickup_datetime").try_cast("timestamp")),
            "k_distance": cents("trip_distance"),
            "k_fare": cents("fare_amount"),
        }
    )


def with_prediction(df: DataFrame, predicted: int) -> DataFrame:
    """Tag rows with a predicted class; normal rows get a null reason of the right type."""
    df = df.withColumn("y_pred", F.lit(predicted))
    return df if predicted else df.withColumn("reason", F.lit(None).cast("string"))


def all_scored(anomalies: DataFrame, normals: DataFrame) -> DataFrame:
    return with_prediction(anomalies, 1).unionByName(with_prediction(normals, 0), allowMissingColumns=True)


def dedupe_labels(labels: DataFrame, order: list[str]) -> DataFrame:
    """First label per fleet and key, in the given order.

    ``min_by`` combines on the map side, so any number of copies of one key reaches the reducer as
    one row per task.
    """
    first = F.min_by(F.struct(*LABEL_COLUMNS), F.struct(*order))
    kept = match_key(labels).groupBy(*FLEET_KEY).agg(first.alias("label"))
    return kept.select(*FLEET_KEY, "label.*")


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on equal keys in which nulls match each other; the key columns are the left ones."""
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    test = F.lit(True)
    for k in keys:
        test = test & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(right, test, how).drop(*[f"_r_{k}" for k in keys])


def match_counts(pred: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows per fleet, prediction and label (null where no label matches).

    Predictions are counted per key before the join, so a key shared by very many trips is joined
    once.
    """
    counted = match_key(pred).groupBy(*FLEET_KEY, "y_pred").agg(F.count("*").alias("n"))
    joined = _join(counted, labels.select(*FLEET_KEY, "is_anomaly"), FLEET_KEY, "left")
    return joined.groupBy("taxi_type", "y_pred", "is_anomaly").agg(F.sum("n").alias("n"))


def match_labels(pred: DataFrame, labels: DataFrame, row_key: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join of predictions with de-duplicated labels, many to one, row by row.

    A key that holds more than 1/10,000 of the predictions is spread over several tasks by a hash of
    the row key, its one label row repeated for each. There can be at most 10,000 such keys, which
    bounds the broadcast list.
    """
    keyed = match_key(pred)
    counts = keyed.groupBy(*FLEET_KEY).agg(F.count("*").alias("n"))
    share = F.greatest(
        counts.agg((F.sum("n") / F.lit(HOT_KEYS)).alias("share")).scalar(), F.lit(float(hot_rows))
    )
    parts = F.ceil(F.col("n") / share).cast("int")
    hot = F.broadcast(counts.filter(F.col("n") > share).select(*FLEET_KEY, parts.alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))

    left = _join(keyed, hot, FLEET_KEY, "left")
    left = left.withColumn("_slot", F.pmod(F.xxhash64(*row_key), parts).cast("int")).drop("_parts")
    right = _join(labels.select(*FLEET_KEY, *LABEL_COLUMNS), hot, FLEET_KEY, "left")
    right = right.withColumn("_slot", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return _join(left, right, [*FLEET_KEY, "_slot"], "inner").select(*pred.columns, *LABEL_COLUMNS)


def fleet_lookup(df: DataFrame, fleets: DataFrame, defaults: dict[str, float]) -> DataFrame:
    """One row per listed fleet; values missing for a fleet take their defaults."""
    joined = fleets.join(df, "taxi_type", "left")
    return joined.fillna(defaults)
