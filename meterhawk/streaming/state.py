"""What a scoring run remembers between micro-batches, kept in tables.

A replayed batch reads only what earlier batches left, and rewrites its own partitions.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterhawk import schema as S
from meterhawk.sources.files import delete, partition_numbers
from meterhawk.sources.tables import one_row

ARRIVAL = ["arrival_source", "arrival_pos"]
STATE_SCHEMA = "processed_batches long, model_version long"
BUFFER_SCHEMA = (
    ", ".join(f"{c} double" for c in S.MODEL_FEATURES) + ", arrival_source string, arrival_pos long"
)
STATES_KEPT = 20


class State(NamedTuple):
    processed_batches: int = 0
    model_version: int | None = None


def read_state(
    spark: SparkSession, root: str, before: int, known: tuple[int, State] | None = None
) -> State:
    """State left by the last batch ahead of ``before``; ``known`` spares reading it back."""
    earlier = [n for n in partition_numbers(spark, f"{root}/state", "batch_id") if n < before]
    if not earlier:
        return State()
    if known and known[0] == earlier[-1]:
        return known[1]
    row = spark.read.schema(STATE_SCHEMA).parquet(f"{root}/state/batch_id={earlier[-1]}").first()
    return State(row["processed_batches"], row["model_version"])


def write_state(spark: SparkSession, root: str, batch_id: int, state: State) -> None:
    df = one_row(spark, state._asdict(), STATE_SCHEMA)
    df.write.mode("overwrite").parquet(f"{root}/state/batch_id={batch_id}")
    for old in partition_numbers(spark, f"{root}/state", "batch_id")[:-STATES_KEPT]:
        delete(spark, f"{root}/state/batch_id={old}")


def newest(df: DataFrame, n: int) -> DataFrame:
    """The last ``n`` rows in arrival order."""
    order = [c for c in ("batch_id", "arrival_pos", "arrival_source") if c in df.columns]
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def append_buffer(df: DataFrame, root: str, batch_id: int, rows: int, n: int = S.BUFFER_ROWS) -> None:
    """Store the rows of a batch that the training buffer can still hold."""
    kept = df.select(*[F.col(c).cast("double").alias(c) for c in S.MODEL_FEATURES], *ARRIVAL)
    kept = kept.coalesce(1) if rows <= n else newest(kept, n)
    kept.write.mode("overwrite").parquet(f"{root}/buffer/batch_id={batch_id}")


def rolling_buffer(spark: SparkSession, root: str, upto: int, n: int = S.BUFFER_ROWS) -> DataFrame:
    """The last ``n`` buffered rows in arrival order, the batch ``upto`` included."""
    df = spark.read.schema(BUFFER_SCHEMA + ", batch_id long").parquet(f"{root}/buffer")
    return newest(df.filter(F.col("batch_id") <= upto), n)


def trim_buffer(spark: SparkSession, root: str, oldest: int) -> None:
    """Drop buffered batches ahead of the oldest one still in use."""
    for number in partition_numbers(spark, f"{root}/buffer", "batch_id"):
        if number < oldest:
            delete(spark, f"{root}/buffer/batch_id={number}")


def put_waiting(df: DataFrame, root: str, batch_id: int, records: int) -> None:
    """Keep a batch that came before the first model, with its number of raw records."""
    kept = df.withColumn("_records", F.lit(records).cast("long"))
    kept.write.mode("overwrite").parquet(f"{root}/waiting/batch_id={batch_id}")


def waiting_batches(spark: SparkSession, root: str, before: int) -> list[int]:
    return [n for n in partition_numbers(spark, f"{root}/waiting", "batch_id") if n < before]


def read_waiting(spark: SparkSession, root: str, batch_id: int) -> tuple[DataFrame, int]:
    df = spark.read.parquet(f"{root}/waiting/batch_id={batch_id}")
    return df.drop("_records"), df.first()["_records"]


def drop_waiting(spark: SparkSession, root: str, batch_id: int) -> None:
    delete(spark, f"{root}/waiting/batch_id={batch_id}")


def should_retrain(state: State, has_model: bool, every: int = S.RETRAIN_EVERY) -> bool:
    """Without a model always; else at every ``every``-th processed batch, not at the first."""
    if not has_model:
        return True
    return state.processed_batches > 0 and state.processed_batches % every == 0
