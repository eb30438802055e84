"""Trips derived from the generic ``events`` table, for tables that hold no trips of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


EVENTS = "event_id long, ts timestamp_ntz, user_id long, value double"

DISTANCE = "CASE WHEN event_id % 211 = 7 THEN 60D ELSE 0D END + CAST(floor(value * 100D / 15D) AS DOUBLE) / 100D"

DURATION = """CASE WHEN event_id % 199 = 3 THEN -30L
    WHEN event_id % 97 = 5 THEN 61 + event_id % 40
    WHEN event_id % 83 = 2 THEN 7300 + event_id % 900
    ELSE CAST(120D + floor(distance * 150D) AS BIGINT) + (event_id * 7919) % 600 END"""

FARE = """CASE WHEN event_id % 73 = 1 THEN 1D
    WHEN event_id % 211 = 7 THEN 20D
    WHEN event_id % 61 = 4 THEN CAST(floor(2400D + 2000D * distance) AS DOUBLE) / 100D
    WHEN event_id % 67 = 9 THEN CAST(floor(100D + 1200D * distance) AS DOUBLE) / 100D
    ELSE CAST(floor(300D + 250D * distance) AS DOUBLE) / 100D END"""

PASSENGERS = "CASE WHEN event_id % 53 = 0 THEN 0D WHEN event_id % 59 = 0 THEN NULL ELSE CAST(1 + event_id % 6 AS DOUBLE) END"


def trips_from_events(events: DataFrame) -> DataFrame:
    """One trip per event, with the odd values a trip feed shows spread over fixed residues of the id."""
    placed = events.selectExpr(
        "event_id", "user_id", "date_trunc('SECOND', CAST(ts AS TIMESTAMP)) AS pickup", f"{DISTANCE} AS distance"
    )
    return placed.selectExpr(
        "event_id AS trip_id",
        "CASE WHEN event_id % 10 < 8 THEN 'yellow' ELSE 'green' END AS taxi_type",
        "user_id % 2 + 1 AS VendorID",
        "pickup AS pickup_datetime",
        f"timestampadd(SECOND, {DURATION}, pickup) AS dropoff_datetime",
        f"{PASSENGERS} AS passenger_count",
        "distance AS trip_distance",
        f"{FARE} AS fare_amount",
    )


def read_event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_events(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"))


def fleet_file(trips: DataFrame, fleet: str) -> DataFrame:
    """The trips of one fleet in the layout of its source file."""
    from meterhawk.sources.trips import time_columns

    names = {logical: source for source, logical in time_columns(fleet).items()}
    return (
        trips.filter(F.col("taxi_type") == fleet)
        .drop("taxi_type")
        .withColumnsRenamed(names)
    )
