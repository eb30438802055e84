"""What the operators share: staged tables, null-safe text, the word rule and the training fold."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterhawk.session import stage
from meterhawk.sources.files import delete

# Fixed value: the white space that parts words (space and the controls from tab to carriage return).
SPACE_CODES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

# Rows and bytes of one Arrow batch, so that long documents do not pile up in a Python worker.
BATCH_ROWS = 2_000
BATCH_BYTES = 8 << 20

HELD_OUT_REMAINDER = 2
FOLDS = 4


def give_back() -> None:
    """Return to the system what this process has freed. Python workers outlive their tasks, so what one stage leaves in their
    allocators would count against the next one."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``task`` for ``mapInArrow``, after whose last batch the worker gives back what it has freed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        give_back()

    return run


class Scratch:
    """Tables an operator writes to the shared folder between its steps, and removes when they are used up.

    A staged table cuts the lineage and is still there when an executor is lost.
    """

    def __init__(self, spark: SparkSession, owner: str):
        self.spark = spark
        self.owner = owner
        self._paths: dict[int, str] = {}
        self._held: list[DataFrame] = []  # keeps the ids above from being used again

    def put(self, df: DataFrame, name: str) -> DataFrame:
        with bounded_batches(self.spark):
            table, path = stage(df, f"{self.owner}-{name}")
        self._paths[id(table)] = path
        self._held.append(table)
        return table

    def same(self, table: DataFrame, view: DataFrame) -> DataFrame:
        """Let ``view`` stand for the staged ``table`` it was derived from."""
        self._paths[id(view)] = self._paths.pop(id(table))
        self._held.append(view)
        return view

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            delete(self.spark, self._paths.pop(id(table)))

    def result(self, df: DataFrame) -> DataFrame:
        """Stage ``df`` as the operator's result and remove everything else. The caller owns the result."""
        earlier = dict(self._paths)
        table = self.put(df, "result")
        for key, path in earlier.items():
            delete(self.spark, path)
            self._paths.pop(key)
        return table


@contextmanager
def bounded_batches(spark: SparkSession):
    """Bound the Arrow batches of the jobs run inside, then put the session back as it was."""
    wanted = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no fit may learn from. A null id counts as the text of no characters."""
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(name) % FOLDS == HELD_OUT_REMAINDER


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int
) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, label) of at most ``per_class`` labelled documents of each class outside the held-out fold,
    taken in the order of a hash of the id; and the labelled rows there are of each class outside that fold."""
    known = labels.where(~held_out() & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select(
        "doc_id", F.col(label).cast("int").alias("label")
    )
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [known.where(F.col("label") == k).distinct().orderBy(*order).limit(per_class) for k in (0, 1)]
    # At most 2 * per_class rows.
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    texts = docs.select("doc_id", text_of("text").alias("text")).join(chosen, "doc_id")
    return texts.dropDuplicates(["doc_id", "label"]), totals
