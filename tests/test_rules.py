import pytest
from pyspark.sql import functions as F

from meterhawk.functions import rules as R

SCHEMA = (
    "avg_speed_kmh double, fare_per_mile double, trip_duration_sec double, fare_amount double, "
    "trip_distance double, passenger_count double, is_night int, anomaly_score double"
)
CALM = dict(speed=30.0, rate=4.0, duration=900.0, fare=12.0, distance=3.0, passengers=1.0, night=0, score=0.1)
NAN = float("nan")


def frame(spark, **change):
    return spark.createDataFrame([tuple({**CALM, **change}.values())], SCHEMA)


STREAM = [
    (dict(), "statistical", "[MEDIUM] Statistical Outlier (IsolationForest)"),
    (dict(speed=140.0), "statistical", None),
    (dict(speed=140.6, score=0.2), "speed", "[HIGH] Unrealistic Speed (>141 km/h)"),
    (dict(rate=15.0), "statistical", None),
    (dict(rate=15.25), "rate", "[MEDIUM] Extremely High Fare per Mile ($15.2/mi)"),
    (dict(duration=119.0, fare=51.0), "short_high_fare", "[MEDIUM] Short Trip, High Fare ($51 in 2min)"),
    (dict(duration=120.0, fare=51.0), "statistical", None),
    (dict(duration=119.0, fare=50.0), "statistical", None),
    (dict(fare=2.49, distance=1.25), "low_fare", "[MEDIUM] Suspiciously Low Fare ($2.49 for 1.2mi)"),
    (dict(fare=2.5), "statistical", None),
    (dict(fare=2.0, distance=0.5), "statistical", None),
    (dict(duration=7201.0, distance=4.9), "long_short_distance", "[MEDIUM] Long Duration, Short Distance (2.0h / 4.9mi)"),
    (dict(duration=7200.0), "statistical", None),
    (dict(duration=7201.0, distance=5.0), "statistical", None),
    (dict(passengers=0.0), "zero_passengers", "[MEDIUM] Zero Passengers Reported"),
    (dict(passengers=None), "zero_passengers", None),
    (dict(passengers=NAN), "zero_passengers", None),
    (dict(night=1, speed=101.0), "night_speed", "[MEDIUM] Night-time Speeding (101 km/h)"),
    (dict(night=1, speed=100.0), "statistical", None),
    (dict(night=0, speed=101.0), "statistical", None),
    (dict(fare=151.0, distance=40.0), "extreme_fare", "[MEDIUM] Extreme Fare Amount ($151)"),
    (dict(fare=150.0), "statistical", None),
    (dict(distance=50.5, rate=0.9), "long_low_rate", "[MEDIUM] Very Long Trip, Suspiciously Low Rate"),
    (dict(distance=50.0, rate=0.9), "statistical", None),
    (dict(distance=50.5, rate=1.0), "statistical", None),
    (dict(speed=150.0, rate=20.0), "speed", None),
    (dict(speed=NAN), "statistical", None),
    (dict(score=0.15), "statistical", "[MEDIUM] Statistical Outlier (IsolationForest)"),
]

BATCH = [
    (dict(), None, None),
    (dict(duration=None), "bad_time", "Negative or missing time"),
    (dict(duration=NAN), "bad_time", None),
    (dict(duration=-1.0), "bad_time", None),
    (dict(duration=0.0), None, None),
    (dict(speed=150.0), None, None),
    (dict(speed=150.5), "speed", "Unrealistic Speed (150 km/h)"),
    (dict(rate=20.5), "rate", "Extremely High Rate ($20.5/mi)"),
    (dict(rate=20.5, distance=0.5), None, None),
    (dict(duration=59.0, fare=31.0), "short_high_fare", "Short Trip, High Fare ($31 in 59s)"),
    (dict(duration=60.0, fare=31.0), None, None),
    (dict(fare=2.0, distance=1.1), "low_fare", "Suspiciously Low Fare ($2.00 for 1.1mi)"),
    (dict(fare=2.0, distance=1.0), None, None),
    (dict(duration=9000.0, distance=1.9), "long_short_distance", "Long Duration, Short Distance (2.5h / 1.9mi)"),
    (dict(duration=9000.0, distance=2.0), None, None),
    (dict(passengers=0.0), "zero_passengers", "Zero Passengers"),
    (dict(passengers=None), None, None),
    (dict(passengers=NAN), None, None),
    (dict(night=1, speed=121.0), "night_speed", "Night-time Speeding (121 km/h)"),
    (dict(night=1, speed=120.0), None, None),
    (dict(fare=251.0), "extreme_fare", "Extreme Fare Amount ($251)"),
    (dict(fare=250.0), None, None),
    (dict(distance=61.0, rate=0.5), "long_low_rate", "Very Long Trip, Suspiciously Low Rate"),
    (dict(distance=60.0, rate=0.5), None, None),
    (dict(speed=NAN, rate=NAN, fare=NAN, distance=NAN), None, None),
]


def check(spark, cases, code, text):
    rows = [(i, *{**CALM, **change}.values()) for i, (change, _, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "n int, " + SCHEMA)
    for r in df.select("n", code.alias("code"), text.alias("text")).collect():
        change, want_code, want_text = cases[r.n]
        assert r.code == want_code, change
        if want_text or want_code is None:
            assert r.text == want_text, change


def test_stream_rules(spark):
    check(spark, STREAM, R.reason_code(), R.reason())


def test_batch_rules(spark):
    check(spark, BATCH, R.batch_reason_code(), R.batch_reason())


def test_violates_agrees_with_the_code(spark):
    rows = [tuple({**CALM, **change}.values()) for change, _, _ in STREAM]
    df = spark.createDataFrame(rows, SCHEMA)
    for r in df.select(R.violates().alias("v"), R.reason_code().alias("c"), R.training_weight().alias("w")).collect():
        assert r.v == (r.c != "statistical")
        assert r.w == (3.0 if r.v else 1.0)


@pytest.mark.parametrize(
    "speed, outlier, flag, text",
    [
        (30.0, False, 0, None),
        (30.0, True, 1, "[AI_OUTLIER] Complex Statistical Anomaly"),
        (200.0, False, 1, "[RULE_VIOLATION] Unrealistic Speed (200 km/h)"),
        (200.0, True, 1, "[RULE_VIOLATION] Unrealistic Speed (200 km/h)"),
    ],
)
def test_label_vote(spark, speed, outlier, flag, text):
    got = frame(spark, speed=speed).select(*R.label_vote(F.lit(outlier))).first()
    assert tuple(got) == (flag, text)
