"""Offline labelling of historical trips: rules first, a large isolation forest second."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterhawk import schema as S
from meterhawk.functions import trips as X
from meterhawk.functions.rules import label_vote
from meterhawk.operators.features import batch_features
from meterhawk.operators.forest import (
    SMALL_INPUT_ROWS,
    add_scores,
    decision_cut,
    fit_forest,
    load_forest,
    with_cut,
)
from meterhawk.operators.normalise import unit_range
from meterhawk.operators.scaler import fit_scaler, impute_median, scale
from meterhawk.session import stage
from meterhawk.sources.files import delete
from meterhawk.sources.trips import read_trips, time_columns

ROW_KEY = ["_row_source", "_row_pos"]
MODEL_PREFIX = "m_"


def _features(df: DataFrame, fleet: str) -> DataFrame:
    """Features beside the source's own datetime columns."""
    parsed = {
        logical: X.parse_time(F.col(source).cast("string")) for source, logical in time_columns(fleet).items()
    }
    return batch_features(df.withColumns(parsed))


def model_inputs(df: DataFrame) -> tuple[DataFrame, list[str], int]:
    """Imputed and robustly scaled copies of the features beside the originals, their names, the row count.

    One pass counts rows and gaps, so that medians are only sought for columns that need them.
    """
    gaps = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c) for c in S.MODEL_FEATURES],
    ).first()
    rows = gaps["rows"]
    holed = [c for c in S.MODEL_FEATURES if gaps[c]]
    whole = [c for c in S.MODEL_FEATURES if not gaps[c]]
    if holed:
        df = impute_median(df, holed, MODEL_PREFIX)
    df = df.withColumns({f"{MODEL_PREFIX}{c}": F.col(c).cast("double") for c in whole})
    names = [f"{MODEL_PREFIX}{c}" for c in S.MODEL_FEATURES]
    return scale(df, fit_scaler(df, names)), names, rows


def label_frame(
    df: DataFrame,
    fleet: str,
    key: list[str] = ROW_KEY,
    trees: int = S.BATCH_TREES,
    sample: int = S.BATCH_SAMPLE,
    contamination: float = S.BATCH_CONTAMINATION,
    seed: int = S.SEED,
) -> tuple[DataFrame, list[str]]:
    """Source rows with features, ``is_anomaly``, ``ai_anomaly_score`` and ``ai_reason``.

    Features are staged once in the shared folder, because medians, quartiles, sampling and scoring all read them, and so are
    scored rows, because the cut and the score range need a pass over all scores before any row can be labelled. Returns the frame and the staged paths, which may
    be deleted once the frame has been written.
    """
    spark = df.sparkSession
    columns = df.columns
    features = _features(df, fleet)
    added = [c for c in features.columns if c not in columns and c not in ("pickup_datetime", "dropoff_datetime")]
    features, features_path = stage(features, "features")
    inputs, names, rows = model_inputs(features)
    nodes, nodes_path = stage(fit_forest(inputs, names, key, trees, sample, seed=seed, rows=rows), "forest")
    forest = load_forest(nodes, names)
    if rows <= SMALL_INPUT_ROWS:
        inputs = inputs.repartition(spark.sparkContext.defaultParallelism, *key)
    scored, paths = add_scores(inputs, forest, "_score")
    scored, scored_path = stage(scored.select(*columns, *added, "_score"), "scored")
    for path in (features_path, nodes_path, *paths):
        delete(spark, path)
    forest = with_cut(forest, decision_cut(scored, "_score", contamination, staged=True))
    span = scored.agg(F.min("_score").alias("low"), F.max("_score").alias("high")).first()
    flag, reason = label_vote(F.col("_score") > F.lit(forest.cut))
    labelled = scored.select(
        *columns,
        *added,
        flag.alias("is_anomaly"),
        unit_range(F.col("_score"), F.lit(span["low"]), F.lit(span["high"])).alias("ai_anomaly_score"),
        reason.alias("ai_reason"),
    )
    return labelled, [scored_path]


def label_totals(df: DataFrame) -> DataFrame:
    """Rows, anomalies and the anomaly share of a labelling run."""
    return df.agg(
        F.count("*").alias("total"),
        F.sum(F.col("is_anomaly").cast("long")).alias("anomalies"),
        F.avg(F.col("is_anomaly").cast("double")).alias("share"),
    )


def write_labels(df: DataFrame, path: str) -> None:
    df.drop(*ROW_KEY).write.mode("overwrite").parquet(path)


def label_trips(spark: SparkSession, source: str, target: str, fleet: str, **options) -> DataFrame:
    """Label one fleet's files and write them; returns the run totals."""
    labelled, staged = label_frame(read_trips(spark, source, fleet, columns=None), fleet, **options)
    write_labels(labelled, target)
    for path in staged:
        delete(spark, path)
    return label_totals(spark.read.parquet(target))
