"""Versioned model store: one folder per version holding four Parquet tables.

The meta table is written last and marks a version complete. A version whose feature list differs
from the current one is removed from the run's own store. One that cannot be read is passed over, so that the
caller fits anew, and stays: the failure may be a passing one.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterhawk import schema as S
from meterhawk.operators.covariance import Covariance
from meterhawk.operators.forest import FOREST_SCHEMA, Forest, load_forest
from meterhawk.operators.scaler import SCALER_SCHEMA, Scaler
from meterhawk.sources.files import delete, exists, partition_numbers

META_SCHEMA = "features array<string>, cut double, contamination double, has_covariance boolean"
COVARIANCE_SCHEMA = "columns array<string>, location array<double>, precision array<array<double>>, threshold double"


@dataclass(frozen=True)
class Model:
    scaler: Scaler
    forest: Forest
    covariance: Covariance | None
    contamination: float


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/models/version={version}"


def save_model(spark: SparkSession, root: str, version: int, nodes: DataFrame, model: Model) -> None:
    base = version_path(root, version)

    def put(df: DataFrame, name: str) -> None:
        df.coalesce(1).write.mode("overwrite").parquet(f"{base}/{name}")

    delete(spark, f"{base}/meta")
    nodes.write.mode("overwrite").parquet(f"{base}/forest")
    put(model.scaler.frame(spark), "scaler")
    cov = model.covariance
    if cov:
        row = (cov.columns, cov.location, cov.precision, cov.threshold)
        put(spark.createDataFrame([row], COVARIANCE_SCHEMA), "covariance")
    meta = (model.forest.columns, model.forest.cut, model.contamination, cov is not None)
    put(spark.createDataFrame([meta], META_SCHEMA), "meta")


def model_is_current(features: list[str], expected: list[str] = S.MODEL_FEATURES) -> bool:
    return list(features) == list(expected)


def load_model(
    spark: SparkSession, root: str, version: int, expected: list[str] = S.MODEL_FEATURES, own: bool = True
) -> Model | None:
    """The stored version, or null when it is stale (then removed from an ``own`` store) or cannot be read."""
    base = version_path(root, version)
    if not exists(spark, f"{base}/meta"):
        return None
    try:
        meta = spark.read.schema(META_SCHEMA).parquet(f"{base}/meta").first()
        if not model_is_current(meta["features"], expected):
            if own:
                delete(spark, base)
            return None
        params = {r["feature"]: r for r in spark.read.schema(SCALER_SCHEMA).parquet(f"{base}/scaler").collect()}
        scaler = Scaler(
            meta["features"],
            [params[c]["center"] for c in meta["features"]],
            [params[c]["scale"] for c in meta["features"]],
        )
        nodes = spark.read.schema(FOREST_SCHEMA).parquet(f"{base}/forest")
        forest = load_forest(nodes, meta["features"], meta["cut"])
        if not forest.blocks:
            raise KeyError("forest")
        covariance = _load_covariance(spark, base, meta["has_covariance"])
    except (PySparkException, Py4JJavaError, KeyError, TypeError):
        return None
    return Model(scaler, forest, covariance, meta["contamination"])


def _load_covariance(spark: SparkSession, base: str, stored: bool) -> Covariance | None:
    """A missing covariance is tolerated: the forest decides alone."""
    if not stored or not exists(spark, f"{base}/covariance"):
        return None
    row = spark.read.schema(COVARIANCE_SCHEMA).parquet(f"{base}/covariance").first()
    return Covariance(row["columns"], row["location"], row["precision"], row["threshold"])


def latest_model(
    spark: SparkSession, root: str, upto: int | None = None, own: bool = True
) -> tuple[int, Model] | None:
    """Newest usable version (not after ``upto``)."""
    versions = partition_numbers(spark, f"{root.rstrip('/')}/models", "version")
    for version in reversed([v for v in versions if upto is None or v <= upto]):
        model = load_model(spark, root, version, own=own)
        if model:
            return version, model
    return None


def model_table(spark: SparkSession, root: str) -> DataFrame:
    """Every stored version's meta row."""
    return spark.read.schema(META_SCHEMA + ", version int").option("basePath", f"{root}/models").parquet(
        f"{root}/models/version=*/meta"
    ).orderBy(F.col("version"))
