"""JSON trip messages and the topic they travel on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from meterhawk import schema as S

# --- Fixed values: topic names and stream options. -----------------------------------------------

TRIP_TOPIC = "taxi_stream"
ANOMALY_TOPIC = "taxi_anomalies"
STREAM_OPTIONS = {
    "startingOffsets": "earliest",
    "failOnDataLoss": "false",
    "maxOffsetsPerTrigger": str(S.MAX_OFFSETS_PER_TRIGGER),
}

# --------------------------------------------------------------------------------------------------


def encode(df: DataFrame) -> DataFrame:
    """One JSON object per row in ``value``."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def decode_trips(df: DataFrame) -> DataFrame:
    """Flatten JSON messages of either shape into trip columns.

    Unknown fields are ignored and missing ones are null. A message without a fleet takes it from
    the prefix of its datetime names. Arrival columns are kept when the frame has them.
    """
    data = F.from_json(F.col("value").cast("string"), S.WIRE)
    arrival = [c for c in ("arrival_source", "arrival_pos") if c in df.columns]
    flat = df.select(data.alias("m"), *arrival)

    def either(end: str):
        return F.coalesce(*[F.col(f"m.{p}{end}_datetime") for p in ("", "tpep_", "lpep_")])

    fleet = F.coalesce(
        F.col("m.taxi_type"),
        F.when(F.col("m.tpep_pickup_datetime").isNotNull(), F.lit("yellow")).when(
            F.col("m.lpep_pickup_datetime").isNotNull(), F.lit("green")
        ),
    )
    return flat.select(
        fleet.alias("taxi_type"),
        F.col("m.VendorID").try_cast("long").alias("VendorID"),
        either("pickup").alias("pickup_datetime"),
        either("dropoff").alias("dropoff_datetime"),
        "m.passenger_count",
        "m.trip_distance",
        "m.fare_amount",
        *arrival,
    )


def stream_options(servers: str, topic: str = TRIP_TOPIC, **extra) -> dict[str, str]:
    """Options of the topic source: earliest offsets, bounded micro-batches, tolerant of lost data."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, **STREAM_OPTIONS, **extra}


def read_trip_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Raw messages of the topic, with the partition and offset that order them."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(
        "value",
        F.concat_ws("/", "topic", "partition").alias("arrival_source"),
        F.col("offset").alias("arrival_pos"),
    )


def read_drop_folder(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """The same stream from a folder of Parquet files that hold a ``value`` column."""
    raw = (
        spark.readStream.schema("value string").option("maxFilesPerTrigger", max_files).parquet(path)
    )
    return raw.select(
        "value",
        F.col("_metadata.file_path").alias("arrival_source"),
        F.col("_metadata.row_index").alias("arrival_pos"),
    )


def publish_options(servers: str, topic: str) -> dict[str, str]:
    """Options of the topic sink (batch and linger sizes as the producers of this feed use them)."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.batch.size": "16384",
        "kafka.linger.ms": "10",
    }


def publish_trips(df: DataFrame, servers: str, topic: str = TRIP_TOPIC) -> None:
    encode(df).write.format("kafka").options(**publish_options(servers, topic)).save()


def publish_anomalies(df: DataFrame, servers: str, topic: str = ANOMALY_TOPIC) -> None:
    publish_trips(df, servers, topic)


def write_raw_lake(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Writer that stores every decoded trip as Parquet; call ``start()`` on it."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
