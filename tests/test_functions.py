import datetime
import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterhawk.functions import trips as X
from meterhawk.operators import features as FE
from meterhawk.operators import normalise as NO
from meterhawk.operators.ensemble import MODES, blend_contamination, vote
from meterhawk.operators.histogram import histogram

QUIET = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
NUMBERS = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False)


def test_fixed_text_matches_printf_rounding(spark):
    rng = np.random.default_rng(1)
    values = [0.5, 1.5, 2.5, 0.25, 1.45, 2.675, 1234567.05, *np.round(rng.uniform(0, 300, 500), 2).tolist()]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select("x", *[F.regexp_replace(X.fixed("x", p), ",", "").alias(f"p{p}") for p in (0, 1, 2)]).collect()
    for r in rows:
        assert (r.p0, r.p1, r.p2) == (f"{r.x:.0f}", f"{r.x:.1f}", f"{r.x:.2f}")


def test_fixed_text_has_no_thousands_separator(spark):
    assert spark.range(1).select(X.fixed(F.lit(1234567.0), 0)).first()[0] == "1234567"


def test_safe_int(spark):
    df = spark.createDataFrame([(2.9,), (-2.9,), (None,), (float("nan"),), (1e300,)], "x double")
    assert [r[0] for r in df.select(X.safe_int("x", 7)).collect()] == [2, -2, 7, 7, 7]
    text = spark.createDataFrame([("12",), ("n/a",), (None,)], "x string")
    assert [r[0] for r in text.select(X.safe_int("x")).collect()] == [12, 0, 0]


def test_parse_time_gives_null_for_unreadable_text(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("NaT",), ("",), (None,)], "t string")
    assert [r[0] is None for r in df.select(X.parse_time("t")).collect()] == [False, True, True, True]


def test_rounding_to_cents_matches_numpy(spark):
    values = [0.125, 2.675, 1.005, 0.285, 1.115, -0.125, 12.345]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(X.cents("x")).collect()] == np.round(values, 2).tolist()


def test_log_feature_keeps_null_and_clamps(spark):
    df = spark.createDataFrame([(-5.0,), (0.0,), (None,), (1.0,)], "x double")
    got = [r[0] for r in df.select(X.log_feature("x", clamp=True)).collect()]
    assert got == [0.0, 0.0, None, math.log1p(1.0)]


def test_flags_of_missing_hour_are_zero(spark):
    row = spark.range(1).select(X.night(F.lit(None).cast("int")), X.rush_hour(F.lit(None).cast("int"))).first()
    assert tuple(row) == (0, 0)


def test_validity_edges(spark):
    base = dict(trip_duration_sec=61, trip_distance=0.11, fare_amount=0.01, passenger_count=1.0)
    edges = [
        ({}, True), ({"trip_duration_sec": 60}, False), ({"trip_distance": 0.1}, False), ({"fare_amount": 0.0}, False),
        ({"passenger_count": 0.0}, False), ({"passenger_count": 9.0}, True), ({"passenger_count": 10.0}, False),
        ({"passenger_count": None}, False), ({"passenger_count": float("nan")}, False),
    ]
    schema = "n int, trip_duration_sec long, trip_distance double, fare_amount double, passenger_count double"
    rows = [(i, *{**base, **change}.values()) for i, (change, _) in enumerate(edges)]
    kept = {r.n for r in FE.valid_trips(spark.createDataFrame(rows, schema)).collect()}
    assert kept == {i for i, (_, ok) in enumerate(edges) if ok}


def trip_rows(spark, rows):
    schema = (
        "trip_id long, taxi_type string, VendorID long, pickup_datetime string, dropoff_datetime string, "
        "passenger_count double, trip_distance double, fare_amount double"
    )
    return spark.createDataFrame(rows, schema)


def test_nan_passes_the_filter_but_not_the_completeness_check(spark):
    times = ("2024-01-01 10:00:00", "2024-01-01 10:10:00")
    rows = [
        (1, "yellow", 1, *times, 1.0, 2.0, 9.0),
        (2, "yellow", 1, *times, 1.0, float("nan"), 9.0),
        (3, "yellow", 1, *times, 1.0, 2.0, float("nan")),
        (4, "yellow", 1, "NaT", times[1], 1.0, 2.0, 9.0),
    ]
    df = trip_rows(spark, rows)
    timed = FE.time_features(df)
    assert {r.trip_id for r in FE.valid_trips(timed).collect()} == {1, 2, 3}
    assert {r.trip_id for r in FE.stream_features(df).collect()} == {1}
    flagged = FE.flagged_stream_features(df).select("trip_id", "is_clean").collect()
    assert {r.trip_id: r.is_clean for r in flagged} == {1: True, 2: False, 3: False, 4: False}


def test_flag_agrees_with_the_filters(spark, sf_dir):
    from meterhawk.plans import samples

    trips = samples.trips(spark, sf_dir)
    flagged = FE.flagged_stream_features(trips).filter("is_clean").drop("is_clean")
    filtered = FE.stream_features(trips).select(*flagged.columns)
    assert flagged.exceptAll(filtered).isEmpty() and filtered.exceptAll(flagged).isEmpty()


def test_duration_keeps_or_cuts_fractions(spark):
    a, b = datetime.datetime(2024, 1, 1, 0, 0, 0, 900000), datetime.datetime(2024, 1, 1, 0, 0, 2, 100000)
    df = spark.createDataFrame([(a, b)], "a timestamp, b timestamp")
    assert tuple(df.select(X.trip_duration("a", "b"), X.trip_duration_exact("a", "b")).first()) == (2, 1.2)


@QUIET
@given(st.lists(NUMBERS, min_size=1, max_size=40))
def test_min_max_stays_in_the_unit_range(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r.u for r in NO.min_max(df, "x", "u").collect()]
    assert all(0.0 <= u <= 1.0 for u in got)
    assert min(got) == 0.0


@QUIET
@given(st.lists(NUMBERS, min_size=1, max_size=60), st.integers(2, 12))
def test_histogram_counts_every_row(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = histogram(df, "x", bins).collect()
    assert sum(r.rows for r in rows) == len(values)
    assert all(0 <= r.bin < bins for r in rows)


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [tuple(r) for r in histogram(df, "x").collect()] == [(0, 2.0, 2.0, 2)]


def test_histogram_matches_numpy(spark):
    x = np.random.default_rng(2).gamma(2, 3, 2000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = {r.bin: r.rows for r in histogram(df, "x", 10).collect()}
    assert [got[i] for i in range(10)] == np.histogram(x, 10)[0].tolist()


def test_histogram_has_every_bin_of_every_group(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 1.0), (None, 0.5), ("b", None)], "g string, x double")
    rows = {(r.g, r.bin): r.rows for r in histogram(df, "x", 4, ["g"]).collect()}
    assert rows == {**{("a", i): n for i, n in enumerate((1, 0, 0, 1))}, **{(None, i): n for i, n in enumerate((0, 0, 1, 0))}}
    assert histogram(df.filter("g = 'b'"), "x", 4).isEmpty()


def test_votes_are_nested(spark):
    df = spark.createDataFrame([(a, b) for a in (0, 1) for b in (0, 1)], "if_flag int, mcd_flag int")
    for r in df.select(*[vote(m).alias(m) for m in MODES]).collect():
        assert r.strict <= r.if_only <= r.union


@QUIET
@given(st.floats(0, 1))
def test_contamination_bounds(spark, rate):
    got = spark.range(1).select(blend_contamination(rate)).first()[0]
    assert 0.024 - 1e-12 <= got <= 0.04 + 1e-12


def test_fleet_summary_keeps_every_fleet(spark):
    from meterhawk.plans.dashboard import fleet_summary

    normals = spark.createDataFrame([("yellow", 4.0), ("yellow", 6.0), (None, 3.0)], "taxi_type string, fare_amount double")
    anomalies = spark.createDataFrame([("yellow", 9.0), ("blue", 1.0)], "taxi_type string, fare_amount double")
    rows = {r.taxi_type: (r.total_normal, r.avg_fare, r.total_anomalies) for r in fleet_summary(normals, anomalies).collect()}
    assert rows == {"yellow": (2, 5.0, 1), "green": (0, 0.0, 0), "blue": (0, 0.0, 1), None: (1, 3.0, 0)}
