import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterhawk.operators import matching as MA
from meterhawk.plans import dashboard as DA
from meterhawk.plans import diagnostics as DI
from meterhawk.plans import evaluation as EV

T0 = datetime.datetime(2024, 1, 1, 10, 0, 30)
PRED = "row long, taxi_type string, pickup_datetime timestamp, trip_distance double, fare_amount double, y_pred int"
LABEL = (
    "pos long, taxi_type string, pickup_datetime timestamp, trip_distance double, fare_amount double, "
    "is_anomaly int, ai_anomaly_score double, ai_reason string"
)


def pred_frame(spark, rows):
    return spark.createDataFrame(rows, PRED)


def label_frame(spark, rows):
    return spark.createDataFrame([(*r, 0.5, None) for r in rows], LABEL)


def test_nulls_match_nulls_and_ties_round_to_even(spark):
    pred = pred_frame(spark, [(1, "green", None, 1.0, 2.0, 1), (2, "green", T0, 0.125, 2.0, 0), (3, "yellow", None, 1.0, 2.0, 0)])
    labels = label_frame(spark, [(1, "green", None, 1.0, 2.0, 1), (2, "green", T0.replace(second=1), 0.12, 2.0, 0)])
    matched = MA.match_labels(pred, MA.dedupe_labels(labels, ["pos"]), ["row"]).collect()
    assert {(r.row, r.is_anomaly) for r in matched} == {(1, 1), (2, 0)}


def test_first_label_in_order_wins(spark):
    labels = label_frame(spark, [(5, "green", T0, 1.0, 2.0, 0), (3, "green", T0, 1.001, 2.0, 1), (9, "green", T0, 1.0, 2.0, 0)])
    kept = MA.dedupe_labels(labels.repartition(3), ["pos"]).collect()
    assert [r.is_anomaly for r in kept] == [1]


def test_hot_key_is_spread_and_whole(spark):
    """A third of the predictions share one (null) key; every one of them still finds its label once."""
    pred = spark.range(9000).select(
        F.col("id").alias("row"),
        F.lit("green").alias("taxi_type"),
        F.when(F.col("id") % 3 != 0, F.timestamp_seconds(F.col("id") * 60)).alias("pickup_datetime"),
        F.lit(1.0).alias("trip_distance"),
        F.lit(2.0).alias("fare_amount"),
        (F.col("id") % 2).cast("int").alias("y_pred"),
    )
    labels = pred.select(
        F.col("row").alias("pos"), "taxi_type", "pickup_datetime", "trip_distance", "fare_amount",
        F.lit(1).alias("is_anomaly"), F.lit(0.5).alias("ai_anomaly_score"), F.lit("x").alias("ai_reason"),
    )
    truth = MA.dedupe_labels(labels, ["pos"])
    matched = MA.match_labels(pred, truth, ["row"], hot_rows=100)
    assert matched.count() == matched.select("row").distinct().count() == 9000
    spread = matched._jdf.queryExecution().optimizedPlan().toString()
    assert "_slot" in spread
    counts = {(r.y_pred, r.is_anomaly): r.n for r in MA.match_counts(pred, truth).collect()}
    assert counts == {(0, 1): 4500, (1, 1): 4500}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 1), st.integers(0, 1)), min_size=1, max_size=40))
def test_confusion_adds_up(spark, rows):
    pred = pred_frame(spark, [(i, "green", T0, float(k), 2.0, y) for i, (k, y, _) in enumerate(rows)])
    labels = label_frame(spark, [(i, "green", T0, float(k), 2.0, t) for i, (k, _, t) in enumerate(rows) if k < 4])
    truth = MA.dedupe_labels(labels, ["pos"])
    report = EV.evaluate(pred, truth).first()
    assert report.tp + report.tn + report.fp + report.fn == report.matched
    assert report.total == len(rows)
    assert report.matched == MA.match_labels(pred, truth, ["row"]).count() == sum(k < 4 for k, _, _ in rows)


def test_ratios_guard_empty_denominators(spark):
    df = spark.createDataFrame([("green", 0, 7, 0, 0)], "taxi_type string, tp long, tn long, fp long, fn long")
    r = EV.ratios(df).first()
    assert (r.precision, r.recall, r.f1, r.accuracy, r.specificity) == (0.0, 0.0, 0.0, 1.0, 1.0)


def test_fleets_with_few_matches_are_left_out(spark):
    df = spark.createDataFrame([("green", 4), ("yellow", 5)], "taxi_type string, matched long")
    assert [r.taxi_type for r in EV.min_matches(df).collect()] == ["yellow"]


METRICS = "batch_id long, inserted_at string, records_processed long, anomalies_detected long, anomaly_rate double, processing_time_ms double, throughput_eps double, estimated_cost_usd double"


def metric_rows(spark, rates):
    rows = [(i, f"2024-01-01 00:{i:02d}", 100, int(100 * r), r, 5.0, 10.0 + i, 0.5) for i, r in enumerate(rates)]
    return spark.createDataFrame(rows, METRICS)


@pytest.mark.parametrize(
    "rates, verdict",
    [([0.02] * 3, "STABLE"), ([0.01, 0.02, 0.03], "MODERATE"), ([0.0, 0.0, 0.3], "UNSTABLE"), ([0.0, 0.0], "STABLE")],
)
def test_rate_stability(spark, rates, verdict):
    assert DI.rate_stability(metric_rows(spark, rates)).first().verdict == verdict


def test_one_batch_gives_no_stability(spark):
    assert DI.rate_stability(metric_rows(spark, [0.1])).isEmpty()


def test_recent_batches(spark):
    metrics = metric_rows(spark, [0.01] * 60)
    assert DA.recent_metrics(metrics).count() == 50
    assert tuple(DA.recent_totals(metrics).first()) == (5000, 25.0)
    assert DA.current_value(metrics, "throughput_eps").first()[0] == 69.0
    assert [r.batch_id for r in DA.series(metrics, "throughput_eps").collect()] == list(range(10, 60))


def test_empty_classes_give_no_report(spark):
    df = spark.createDataFrame([(0.1,), (0.2,)], "anomaly_score double")
    none = df.limit(0)
    assert DI.score_separation(df, none).isEmpty() and DI.score_distribution(none, df).isEmpty()
    assert DI.reason_coverage(spark.createDataFrame([], "reason_code string")).isEmpty()


def test_one_reason_is_narrow(spark):
    df = spark.createDataFrame([("statistical",)] * 3, "reason_code string")
    row = DI.reason_coverage(df).first()
    assert (row.verdict, row.fallback_share, row.reasons) == ("NARROW", 1.0, 1)
