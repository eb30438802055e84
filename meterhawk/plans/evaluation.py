"""Accuracy of streamed predictions against labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterhawk import schema as S
from meterhawk.functions.grades import f1_grade
from meterhawk.operators.matching import match_counts

RATIOS = ["precision", "recall", "f1", "accuracy", "specificity"]


def confusion(counts: DataFrame) -> DataFrame:
    """Totals and confusion counts per fleet from counts per (prediction, label)."""

    def cell(pred: int, true: int) -> Column:
        hit = (F.col("y_pred") == pred) & (F.col("is_anomaly") == true)
        return F.sum(F.when(hit, F.col("n")).otherwise(F.lit(0)))

    return counts.groupBy("taxi_type").agg(
        F.sum(F.when(F.col("is_anomaly").isNotNull(), F.col("n")).otherwise(F.lit(0))).alias("matched"),
        F.sum("n").alias("total"),
        cell(1, 1).alias("tp"),
        cell(0, 0).alias("tn"),
        cell(1, 0).alias("fp"),
        cell(0, 1).alias("fn"),
    )


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def ratios(df: DataFrame) -> DataFrame:
    """Add the five accuracy ratios; an empty denominator gives 0."""
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn"))
    df = df.withColumns({"precision": _share(tp, tp + fp), "recall": _share(tp, tp + fn)})
    p, r = F.col("precision"), F.col("recall")
    return df.withColumns(
        {
            "f1": _share(F.lit(2.0) * p * r, p + r),
            "accuracy": _share(tp + tn, tp + tn + fp + fn),
            "specificity": _share(tn, tn + fp),
        }
    )


def min_matches(df: DataFrame, n: int = S.MIN_MATCHES) -> DataFrame:
    return df.filter(F.col("matched") >= n)


def evaluate(pred: DataFrame, labels: DataFrame) -> DataFrame:
    """Report per fleet; ``labels`` are de-duplicated."""
    return ratios(confusion(match_counts(pred, labels)))


def macro_average(report: DataFrame) -> DataFrame:
    """Means of the ratios over fleets and sums of the counts."""
    return report.agg(
        *[F.avg(c).alias(c) for c in ("f1", "precision", "recall", "accuracy")],
        *[F.sum(c).alias(c) for c in ("matched", "tp", "fp", "fn")],
    )


def overall(report: DataFrame, n: int = S.MIN_MATCHES) -> DataFrame:
    """Headline figures over the fleets with enough matches."""
    return macro_average(min_matches(report, n)).withColumn("grade", f1_grade("f1"))


def profile(report: DataFrame) -> DataFrame:
    """The five ratios in percent, one row per fleet and ratio."""
    percent = report.select("taxi_type", *[(F.col(c) * 100).alias(c) for c in RATIOS])
    return percent.unpivot("taxi_type", RATIOS, "metric", "percent")


def detail_flags(df: DataFrame) -> DataFrame:
    """Class names and whether prediction and label agree."""

    def name(column: str) -> Column:
        return F.when(F.col(column) == 1, "Anomaly").when(F.col(column) == 0, "Normal")

    agree = F.when(F.col("y_pred") == F.col("is_anomaly"), "Yes").otherwise("No")
    return df.withColumns({"streaming_prediction": name("y_pred"), "ground_truth": name("is_anomaly"), "correct": agree})


DETAIL_COLUMNS = [
    "pickup_datetime",
    "trip_distance",
    "fare_amount",
    "anomaly_score",
    "ai_anomaly_score",
    "streaming_prediction",
    "ground_truth",
    "correct",
    "ai_reason",
]


def detail_rows(matched: DataFrame, order: list[str | Column], n: int = S.DETAIL_ROWS) -> DataFrame:
    """The first matched trips with readable classes."""
    return detail_flags(matched.orderBy(*order).limit(n)).select(*DETAIL_COLUMNS)
