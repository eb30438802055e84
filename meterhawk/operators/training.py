"""Fitting and applying the two-detector ensemble."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterhawk import schema as S
from meterhawk.functions.rules import training_weight
from meterhawk.operators.covariance import NoSpread, fit_covariance, score_covariance
from meterhawk.operators.ensemble import adaptive_contamination, vote
from meterhawk.operators.forest import (
    add_scores,
    decision_cut,
    fit_forest,
    load_forest,
    score_forest,
    with_cut,
)
from meterhawk.operators.scaler import fit_scaler, scale
from meterhawk.session import stage
from meterhawk.sources.files import delete
from meterhawk.sources.models import Model

SCALED = "z_"


def scaled_names(columns: list[str]) -> list[str]:
    return [f"{SCALED}{c}" for c in columns]


def train_ensemble(
    df: DataFrame,
    key: list[Column | str],
    contamination: float,
    trees: int = S.STREAM_TREES,
    sample: int = S.STREAM_SAMPLE,
    seed: int = S.SEED,
) -> tuple[DataFrame, Model]:
    """Fit scaler, forest (rule breakers drawn more often) and covariance on feature rows.

    Returns the forest table to store and the model to score with.
    """
    spark = df.sparkSession
    scaler = fit_scaler(df, S.MODEL_FEATURES)
    weighted = df.select("*", training_weight().alias("_w"))
    scaled = scale(weighted, scaler).select(*S.MODEL_FEATURES, "_w", *key)
    nodes = fit_forest(scaled, S.MODEL_FEATURES, key, trees, sample, F.col("_w"), seed)
    nodes, _ = stage(nodes, "forest")
    forest = load_forest(nodes, S.MODEL_FEATURES)
    scores, paths = add_scores(scaled, forest, "s")
    cut = decision_cut(scores, "s", contamination)
    for path in paths:
        delete(spark, path)
    try:
        covariance = fit_covariance(scaled, S.COVARIANCE_FEATURES)
    except NoSpread:
        covariance = None
    return nodes, Model(scaler, with_cut(forest, cut), covariance, contamination)


def score_ensemble(df: DataFrame, model: Model, mode: str = "strict") -> DataFrame:
    """Add ``if_score, if_flag, mah_distance, mcd_flag, is_anomaly`` to feature rows."""
    features = model.forest.columns
    original = df.columns
    df = score_forest(scale(df, model.scaler, SCALED), model.forest, scaled_names(features))
    if model.covariance:
        df = score_covariance(df, model.covariance, scaled_names(model.covariance.columns))
    else:
        mode = "if_only"
        df = df.withColumns({"mah_distance": F.lit(0.0), "mcd_flag": F.lit(0)})
    added = ["if_score", "if_flag", "mah_distance", "mcd_flag"]
    return df.select(*original, *added, vote(mode).alias("is_anomaly"))


def retrain_contamination(df: DataFrame, model: Model | None, prior: float = S.CONTAMINATION_PRIOR) -> float:
    """Contamination for the next fit: the prior, blended with the share the current forest flags."""
    if model is None:
        return prior
    flagged = score_forest(scale(df, model.scaler), model.forest)
    return adaptive_contamination(flagged, "if_flag", prior).first()["contamination"]
