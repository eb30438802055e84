"""Result tables: Parquet under one root, one partition per micro-batch.

A batch owns its partition and overwrites it, so a retried batch leaves the tables unchanged.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterhawk import schema as S
from meterhawk.functions.trips import parse_time, safe_int
from meterhawk.sources.files import delete, exists

ROWS_PER_FILE = 1_000_000


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def table_schema(table: str) -> T.StructType:
    return T.StructType([*S.RESULT_TABLES[table].fields, T.StructField("batch_id", T.LongType(), True)])


def create_result_tables(spark: SparkSession, root: str, tables: list[str] | None = None) -> None:
    """Register the result tables in the session's catalog; existing ones are kept."""
    for table in tables or S.RESULT_TABLES:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table_schema(table).fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
            f"PARTITIONED BY (batch_id) LOCATION '{table_path(root, table)}'"
        )


def drop_result_tables(spark: SparkSession, root: str | None = None, tables: list[str] | None = None) -> None:
    """Drop the tables from the catalog and, with a root, their files."""
    for table in tables or S.RESULT_TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        if root:
            delete(spark, table_path(root, table))


def evolve(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; the ones the frame lacks become null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def read_results(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A result table; files written before a column existed read as null there."""
    path = table_path(root, table)
    if not exists(spark, path):
        return spark.createDataFrame([], table_schema(table))
    return spark.read.schema(table_schema(table)).parquet(path)


def show_batch(spark: SparkSession, root: str, table: str, batch_id: int) -> None:
    """Make a written batch visible under the table's name, where that name stands for this root."""
    if not spark.catalog.tableExists(table):
        return
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()
    path = table_path(root, table)
    if place and place["data_type"].split(":", 1)[-1].rstrip("/") == path.split(":", 1)[-1]:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (batch_id = {batch_id}) LOCATION '{path}/batch_id={batch_id}'")


def write_batch(df: DataFrame, root: str, table: str, batch_id: int, rows: int | None = None) -> None:
    """Overwrite one batch of a table. ``rows`` (when known) keeps small batches in few files."""
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))
    path = f"{table_path(root, table)}/batch_id={batch_id}"
    evolve(df, S.RESULT_TABLES[table]).write.mode("overwrite").parquet(path)
    show_batch(df.sparkSession, root, table, batch_id)


def stored_trip_columns() -> dict[str, Column]:
    """Casts from scored trips to the stored types, with their fallback integers."""
    return {
        "VendorID": safe_int("VendorID"),
        "pickup_datetime": parse_time(F.col("pickup_datetime").cast("string")),
        "dropoff_datetime": parse_time(F.col("dropoff_datetime").cast("string")),
        "passenger_count": safe_int("passenger_count", 1),
        "trip_duration_sec": safe_int("trip_duration_sec"),
    }


def to_stored(df: DataFrame, now: datetime | None = None) -> DataFrame:
    """Trips as they are stored; ``now`` lets several writes carry the same time."""
    return df.withColumns({**stored_trip_columns(), "inserted_at": F.lit(now) if now else F.current_timestamp()})


def write_anomalies(df: DataFrame, root: str, batch_id: int, rows: int | None = None) -> None:
    """Append the anomalies among stored trips."""
    write_batch(df, root, "anomalous_trips", batch_id, rows)


def normal_sample(
    df: DataFrame, order: list[str | Column], n: int = S.NORMAL_SAMPLE_ROWS, by: str | None = None
) -> DataFrame:
    """The first ``n`` rows in arrival order, of the frame or of each group of ``by``."""
    if by is None:
        return df.orderBy(*order).limit(n)
    place = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def write_normal_sample(
    df: DataFrame, root: str, batch_id: int, order: list[str], n: int = S.NORMAL_SAMPLE_ROWS
) -> None:
    """Append the first normal trips among stored trips."""
    write_batch(normal_sample(df, order, n), root, "normal_trips", batch_id, n)


def one_row(spark: SparkSession, values: dict, schema: T.StructType | str) -> DataFrame:
    """A row of literals, planned without leaving the JVM."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    columns = [F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0, 1, 1, 1).select(*columns)


def write_metrics(spark: SparkSession, root: str, batch_id: int, row: dict) -> None:
    schema = T.StructType([f for f in S.BATCH_METRICS.fields if f.name != "inserted_at"])
    df = one_row(spark, row, schema).withColumn("inserted_at", F.current_timestamp())
    write_batch(df, root, "pipeline_metrics", batch_id)


def jdbc_options(url: str, table: str, user: str, password: str, **extra) -> dict[str, str]:
    """Options for keeping a result table in a relational database instead."""
    return {"url": url, "dbtable": table, "user": user, "password": password, **extra}


JDBC_SPLIT = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Read a table in parallel slices of a column; without them one task would read it all."""
    if missing := [name for name in JDBC_SPLIT if name not in options]:
        raise ValueError(f"a parallel read needs {', '.join(missing)}")
    reader: DataFrameReader = spark.read.format("jdbc")
    return reader.options(**options).load()


def append_jdbc(df: DataFrame, options: dict[str, str]) -> None:
    df.write.format("jdbc").options(**options).mode("append").save()
