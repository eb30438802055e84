"""Model-health reports over the result tables.

Every report reads its whole tables; ``cap`` limits it to a sample where that is wanted.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterhawk import schema as S
from meterhawk.functions import grades
from meterhawk.functions.rules import STREAM_FALLBACK, violates
from meterhawk.functions.trips import night, pickup_hour
from meterhawk.operators.features import derived_features, drop_any_null
from meterhawk.operators.forest import Forest
from meterhawk.operators.histogram import histogram
from meterhawk.operators.scaler import scale
from meterhawk.sources.models import Model

CLASSES = ["normal", "anomaly"]
# Fewer rows than this say nothing about a rate.
SENSITIVITY_MIN_ROWS = 50
# Rows of one bucket in which values are exchanged.
PAIRING_ROWS = 5_000


def sample_cap(df: DataFrame, n: int | None, order: list[str | Column]) -> DataFrame:
    """At most ``n`` rows, the same ones every time; all rows without ``n``."""
    return df if n is None else df.orderBy(*order).limit(n)


def both_classes(normals: DataFrame, anomalies: DataFrame, column: str = "anomaly_score") -> DataFrame:
    """The non-null scores of both classes, tagged."""
    parts = [
        df.filter(F.col(column).isNotNull()).select(F.col(column), F.lit(name).alias("class"))
        for name, df in zip(CLASSES, (normals, anomalies))
    ]
    return parts[0].unionByName(parts[1])


def score_moments(scores: DataFrame, column: str = "anomaly_score") -> DataFrame:
    """Rows, mean and sample deviation per class."""
    return scores.groupBy("class").agg(
        F.count("*").alias("n"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std")
    )


def _by_class(scores: DataFrame, column: str = "anomaly_score") -> DataFrame:
    """Both classes' moments on one row."""

    def of(name: str) -> Column:
        return F.when(F.col("class") == name, F.col(column))

    return scores.agg(
        *[
            f(of(name)).alias(f"{name}_{label}")
            for name in CLASSES
            for label, f in (("n", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
        ]
    )


def score_separation(normals: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Cohen's d between both classes' scores, with a verdict; no row unless both classes have scores."""
    row = _by_class(both_classes(normals, anomalies))
    row = row.filter((F.col("normal_n") > 0) & (F.col("anomaly_n") > 0))
    pooled = F.sqrt((F.pow("normal_std", F.lit(2)) + F.pow("anomaly_std", F.lit(2))) / 2)
    effect = F.abs(F.col("anomaly_mean") - F.col("normal_mean")) / (pooled + F.lit(S.SCORE_GUARD))
    return row.select(
        *[f"{c}_{m}" for c in CLASSES for m in ("n", "mean", "std")], effect.alias("cohens_d")
    ).withColumn("verdict", grades.separation_verdict(F.col("cohens_d")))


def rate_stability(metrics: DataFrame) -> DataFrame:
    """Mean, deviation and coefficient of variation of the batch anomaly rates (two batches at least)."""
    row = metrics.filter(F.col("anomaly_rate").isNotNull()).agg(
        F.count("*").alias("batches"),
        F.avg("anomaly_rate").alias("mean_rate"),
        F.stddev_samp("anomaly_rate").alias("std_rate"),
    )
    row = row.filter(F.col("batches") >= 2)
    row = row.withColumn("cv", F.col("std_rate") / (F.col("mean_rate") + F.lit(S.SCORE_GUARD)))
    return row.withColumn("verdict", grades.stability_verdict(F.col("cv")))


def rate_series(metrics: DataFrame) -> DataFrame:
    """Rates per batch in batch order."""
    known = metrics.filter(F.col("anomaly_rate").isNotNull())
    return known.select("batch_id", "anomaly_rate", "anomalies_detected", "records_processed").orderBy("batch_id")


def reason_shares(anomalies: DataFrame, by: str = "reason_code") -> DataFrame:
    """Anomalies per reason with their share of all anomalies, most frequent first."""
    counted = anomalies.groupBy(by).agg(F.count("*").alias("cnt"))
    total = counted.agg(F.sum("cnt").alias("total")).scalar()
    return counted.withColumn("share", F.col("cnt") / total).orderBy(F.desc("cnt"), by)


def reason_coverage(anomalies: DataFrame) -> DataFrame:
    """Distinct reasons, share of the statistical fallback, and a verdict; no row without anomalies."""
    counted = anomalies.groupBy("reason_code").agg(F.count("*").alias("cnt"))
    fallback = F.when(F.col("reason_code") == STREAM_FALLBACK.code, F.col("cnt")).otherwise(F.lit(0))
    row = counted.agg(
        F.sum("cnt").alias("anomalies"), F.count("*").alias("reasons"), F.sum(fallback).alias("_pure")
    ).filter(F.col("reasons") > 0)
    share = F.col("_pure") / F.col("anomalies")
    return row.select(
        "anomalies",
        "reasons",
        share.alias("fallback_share"),
        grades.coverage_verdict(F.col("reasons"), share).alias("verdict"),
    )


def rule_overlap(anomalies: DataFrame) -> DataFrame:
    """Share of anomalies that also break a business rule, with a verdict; no row without anomalies."""
    if "is_night" not in anomalies.columns:
        anomalies = anomalies.withColumn("is_night", night(pickup_hour("pickup_datetime")))
    row = anomalies.agg(F.count("*").alias("anomalies"), F.count_if(violates()).alias("rule_breakers"))
    row = row.filter(F.col("anomalies") > 0)
    row = row.withColumn("overlap", F.col("rule_breakers") / F.col("anomalies"))
    return row.withColumn("verdict", grades.overlap_verdict(F.col("overlap")))


def score_distribution(normals: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Score range per class, the gap between the means, and a verdict."""
    row = _by_class(both_classes(normals, anomalies))
    row = row.filter((F.col("normal_n") > 0) & (F.col("anomaly_n") > 0))
    return row.select(
        *[(F.col(f"{c}_max") - F.col(f"{c}_min")).alias(f"{c}_range") for c in CLASSES],
        (F.col("anomaly_mean") - F.col("normal_mean")).alias("gap"),
    ).withColumn("verdict", grades.gap_verdict(F.col("gap")))


def class_histograms(normals: DataFrame, anomalies: DataFrame, column: str = "anomaly_score", bins: int = 10) -> DataFrame:
    """One histogram per class, each over its own range."""
    parts = [
        histogram(df, column, bins).withColumn("class", F.lit(name)) for name, df in zip(CLASSES, (normals, anomalies))
    ]
    return parts[0].unionByName(parts[1])


def rank_features(importances: DataFrame) -> DataFrame:
    """Importances scaled by the largest, highest first."""
    top = importances.agg(F.max("importance").alias("top")).scalar()
    relative = F.col("importance") / (top + F.lit(S.SCORE_GUARD))
    return importances.withColumn("relative", relative).orderBy(F.desc("importance"), "feature")


def top_feature(importances: DataFrame) -> DataFrame:
    """The most influential feature; the first by name on ties."""
    return importances.agg(F.min_by("feature", F.struct(-F.col("importance"), "feature")).alias("feature"))


def permutation_sensitivity(
    normals: DataFrame,
    anomalies: DataFrame,
    model: Model,
    order: list[str],
    seed: int = S.SEED,
    min_rows: int = SENSITIVITY_MIN_ROWS,
    bucket_rows: int = PAIRING_ROWS,
) -> DataFrame:
    """Absolute change of the flag rate when one feature at a time is shuffled, over all rows of both classes.

    Rows are dealt once, by a hash of their key ``order``, into buckets of about ``bucket_rows``. In a bucket each feature's
    values change rows by a permutation of its own, seeded by bucket and feature over rows in the order of their keys, and
    the forest walks a row again only in trees whose path compares the feature. Returns no row for fewer than ``min_rows`` rows.
    """
    base = ["trip_distance", "fare_amount", "trip_duration_sec", "avg_speed_kmh", "fare_per_mile", "passenger_count"]

    def narrow(df: DataFrame) -> DataFrame:
        return df.select(*base, pickup_hour("pickup_datetime").alias("pickup_hour"), F.xxhash64(*order).alias("_id"))

    rows = drop_any_null(narrow(anomalies).unionByName(narrow(normals)))
    total = rows.count()
    if total < max(min_rows, 1):
        return _no_importances(normals)
    features = model.forest.columns
    buckets = -(-total // bucket_rows)
    dealt = scale(derived_features(rows), model.scaler).select(
        "_id", F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(buckets)).alias("_bucket"), *[F.col(c).cast("float") for c in features]
    )
    counted = dealt.groupBy("_bucket").applyInPandas(_flag_counts(normals.sparkSession, model.forest, seed), "trial int, flagged long")
    # One row per feature.
    found = {r["trial"]: r["flagged"] / total for r in counted.groupBy("trial").agg(F.sum("flagged").alias("flagged")).collect()}
    result = [(c, abs(found[i + 1] - found[0])) for i, c in enumerate(features)]
    return rank_features(normals.sparkSession.createDataFrame(result, "feature string, importance double"))


def bucket_permutation(rows: int, bucket: int, feature: int, seed: int) -> np.ndarray:
    """The row each of a bucket's rows takes its value of a feature from."""
    return np.random.default_rng([seed, bucket, feature]).permutation(rows)


def _flag_counts(spark: SparkSession, forest: Forest, seed: int):
    """Flagged rows of a bucket: as they are, then with each feature shuffled."""
    sent = [forest.broadcast(spark, n) for n in range(len(forest.blocks))]
    columns, expected, cut = forest.columns, forest.expected, forest.cut

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bucket = int(pdf["_bucket"].iat[0])
        points = pdf.sort_values(["_id", *columns])[columns].to_numpy(dtype=np.float32)
        donors = np.column_stack([points[bucket_permutation(len(points), bucket, i, seed), i] for i in range(len(columns))])
        totals = sum(block.value.swapped_paths(points, donors) for block in sent)
        flagged = (np.exp2(-totals / expected) > cut).sum(axis=1)
        return pd.DataFrame({"trial": np.arange(len(flagged), dtype=np.int32), "flagged": flagged})

    return run


def _no_importances(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "feature string, importance double, relative double")
