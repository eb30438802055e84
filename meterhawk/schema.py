"""Data model: column lists, record types, and the fixed values results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: names and numbers that results must agree on. ---------------------------------

FLEETS = ["yellow", "green"]

# Datetime prefix each fleet's files use.
FLEET_PREFIX = {"yellow": "tpep", "green": "lpep"}

BASE_FEATURES = [
    "trip_distance",
    "fare_amount",
    "trip_duration_sec",
    "avg_speed_kmh",
    "pickup_hour",
    "fare_per_mile",
    "passenger_count",
]

MODEL_FEATURES = [
    "trip_distance",
    "fare_amount",
    "trip_duration_sec",
    "avg_speed_kmh",
    "fare_per_mile",
    "passenger_count",
    "hour_sin",
    "hour_cos",
    "speed_x_duration",
    "log_distance",
    "log_fare",
    "is_rush_hour",
    "is_night",
    "fare_distance_ratio",
]

COVARIANCE_FEATURES = [
    "trip_distance",
    "fare_amount",
    "trip_duration_sec",
    "avg_speed_kmh",
    "fare_per_mile",
    "speed_x_duration",
    "fare_distance_ratio",
]

KM_PER_MILE = 1.60934
RUSH_HOURS = [7, 8, 9, 17, 18, 19]
NIGHT_HOURS = [0, 1, 2, 3, 4, 5]
RATIO_OFFSET_MILES = 0.001
BATCH_EPSILON = 1e-5

MIN_DURATION_SEC = 60
MIN_DISTANCE = 0.1
MIN_FARE = 0
MIN_PASSENGERS = 1
MAX_PASSENGERS = 9

MIN_BATCH_ROWS = 10
MIN_TRAINING_ROWS = 50
BUFFER_ROWS = 10_000
RETRAIN_EVERY = 25
NORMAL_SAMPLE_ROWS = 50
MAX_OFFSETS_PER_TRIGGER = 5_000
COST_USD_PER_MS = 0.000016

SEED = 42
STREAM_TREES = 200
STREAM_SAMPLE = 256
BATCH_TREES = 300
BATCH_SAMPLE = 256_000
BATCH_CONTAMINATION = 0.02
CONTAMINATION_PRIOR = 0.03
PRIOR_SHARE = 0.8
OBSERVED_SHARE = 0.2
CONTAMINATION_FLOOR = 0.01
CONTAMINATION_CEILING = 0.04
RULE_BREAKER_WEIGHT = 3.0

COVARIANCE_SUPPORT = 0.85
DISTANCE_QUANTILE = 0.975
FOREST_SHARE = 0.6
DISTANCE_SHARE = 0.4
SCORE_GUARD = 1e-9
HIGH_SEVERITY_SCORE = 0.15

MIN_MATCHES = 5
DETAIL_ROWS = 100
RECENT_BATCHES = 50
LATEST_TRIPS = 500
LIVE_TRIPS = 8

# --- Record types. -------------------------------------------------------------------------------

_string, _long, _int, _double = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_timestamp, _boolean = T.TimestampType(), T.BooleanType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


MESSAGE = _struct(
    ("taxi_type", _string),
    ("VendorID", _long),
    ("pickup_datetime", _string),
    ("dropoff_datetime", _string),
    ("passenger_count", _double),
    ("trip_distance", _double),
    ("fare_amount", _double),
)

# What the decoder asks from_json for: numbers as double (an integer field would turn 2.0 into null)
# and every name a datetime may carry.
WIRE = _struct(
    ("taxi_type", _string),
    ("VendorID", _double),
    ("pickup_datetime", _string),
    ("dropoff_datetime", _string),
    ("tpep_pickup_datetime", _string),
    ("tpep_dropoff_datetime", _string),
    ("lpep_pickup_datetime", _string),
    ("lpep_dropoff_datetime", _string),
    ("passenger_count", _double),
    ("trip_distance", _double),
    ("fare_amount", _double),
)

NORMAL_TRIPS = _struct(
    ("taxi_type", _string),
    ("VendorID", _int),
    ("pickup_datetime", _timestamp),
    ("dropoff_datetime", _timestamp),
    ("passenger_count", _int),
    ("trip_distance", _double),
    ("fare_amount", _double),
    ("trip_duration_sec", _int),
    ("avg_speed_kmh", _double),
    ("fare_per_mile", _double),
    ("anomaly_score", _double),
    ("if_score", _double),
    ("mah_distance", _double),
    ("arrival_source", _string),
    ("arrival_pos", _long),
    ("inserted_at", _timestamp),
)

ANOMALOUS_TRIPS = T.StructType(
    [*NORMAL_TRIPS.fields, T.StructField("reason", _string), T.StructField("reason_code", _string)]
)

SCORED_TRIPS = T.StructType(
    [*ANOMALOUS_TRIPS.fields, T.StructField("is_anomaly", _int), T.StructField("pickup_hour", _int)]
)

BATCH_METRICS = _struct(
    ("records_processed", _long),
    ("anomalies_detected", _long),
    ("anomaly_rate", _double),
    ("processing_time_ms", _double),
    ("throughput_eps", _double),
    ("estimated_cost_usd", _double),
    ("model_retrained", _boolean),
    ("inserted_at", _timestamp),
)

RESULT_TABLES = {
    "normal_trips": NORMAL_TRIPS,
    "anomalous_trips": ANOMALOUS_TRIPS,
    "pipeline_metrics": BATCH_METRICS,
    "scored_trips": SCORED_TRIPS,
}
