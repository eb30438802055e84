"""Queries without SQL cover the whole of their job, and so do the operators whose SQL covers a part."""

import json

import numpy as np

from meterhawk import schema as S
from meterhawk.operators.scaler import fit_scaler
from meterhawk.plans import catalog
from meterhawk.plans import samples as P
from meterhawk.sources import messages, trips
from meterhawk.sources.events import fleet_file


def test_labelling_covers_every_fleet(spark, sf_dir):
    wanted = {r.trip_id for r in P.trips(spark, sf_dir).select("trip_id").collect()}
    found = [r.trip_id for r in catalog.offline_labelling(spark, sf_dir).collect()]
    assert set(found) == wanted and len(found) == len(wanted)


def test_encoding_takes_every_fleet(spark, sf_dir):
    given = P.trips(spark, sf_dir)
    for fleet in S.FLEETS:
        rows = trips.zero_fill(trips.stringify_times(trips.project_source(fleet_file(given, fleet), fleet)))
        sent = [json.loads(r.value) for r in messages.encode(rows).collect()]
        assert len(sent) == given.where(f"taxi_type = '{fleet}'").count() > 0
        assert {m["taxi_type"] for m in sent} == {fleet}


def test_scaler_takes_every_model_feature(spark, sf_dir):
    rows = P.features(spark, sf_dir).select(*S.MODEL_FEATURES)
    values = np.array(rows.collect(), float)
    fitted = fit_scaler(rows, S.MODEL_FEATURES)
    low, middle, high = np.percentile(values, [25, 50, 75], axis=0)
    assert np.allclose(fitted.center, middle)
    assert np.allclose(fitted.scale, np.where(high == low, 1.0, high - low))


def _scored_ids(spark, sf_dir):
    """Every trip has a label, so that every scored trip finds one."""
    return sorted(r.trip_id for r in P.scored(spark, sf_dir).select("trip_id").collect())


def test_matches_take_every_label(spark, sf_dir):
    assert sorted(r.trip_id for r in catalog.label_matches(spark, sf_dir).collect()) == _scored_ids(spark, sf_dir)


def test_deduplication_takes_every_label(spark, sf_dir):
    rows = P.labels(spark, sf_dir).select("taxi_type", "pickup_datetime", "trip_distance", "fare_amount").collect()
    keys = {(r[0], r[1] and r[1].replace(second=0), *(None if v is None else round(v, 2) for v in r[2:])) for r in rows}
    assert catalog.deduplicated_labels(spark, sf_dir).count() == len(keys)


def _confusion(spark, sf_dir):
    """(tp, tn, fp, fn) of each fleet from the trips themselves: the first trip of a key has its label."""
    first, found = {}, {}
    key = lambda r: (r.taxi_type, r.pickup_datetime.replace(second=0), round(r.trip_distance, 2), round(r.fare_amount, 2))
    for r in P.labels(spark, sf_dir).orderBy("trip_id").collect():
        if r.pickup_datetime is not None and r.trip_distance is not None and r.fare_amount is not None:
            first.setdefault(key(r), r.is_anomaly)
    for r in P.scored(spark, sf_dir).collect():
        kind = {(1, 1): 0, (0, 0): 1, (1, 0): 2, (0, 1): 3}[r.is_anomaly, first[key(r)]]
        found.setdefault(r.taxi_type, [0] * 4)[kind] += 1
    return found


def test_confusion_takes_every_label(spark, sf_dir):
    rows = catalog.confusion_counts(spark, sf_dir).collect()
    assert {r.taxi_type: [r.tp, r.tn, r.fp, r.fn] for r in rows} == _confusion(spark, sf_dir)
    assert all(r.matched == r.total for r in rows)


def test_ratios_take_every_label(spark, sf_dir):
    for r in catalog.accuracy_ratios(spark, sf_dir).collect():
        tp, tn, fp, fn = _confusion(spark, sf_dir)[r.taxi_type]
        assert np.allclose([r.precision, r.recall, r.accuracy], [tp / (tp + fp), tp / (tp + fn), (tp + tn) / (tp + tn + fp + fn)], atol=1e-6)


def test_macro_averages_take_every_label(spark, sf_dir):
    counts = np.array(list(_confusion(spark, sf_dir).values()))
    row = catalog.macro_averages(spark, sf_dir).first()
    assert [row.matched, row.tp, row.fp, row.fn] == [counts.sum(), *counts.sum(axis=0)[[0, 2, 3]]]


def test_score_histogram_takes_every_label(spark, sf_dir):
    held = [r.rows for r in catalog.score_histogram_by_class(spark, sf_dir).collect()]
    assert sum(held) == len(_scored_ids(spark, sf_dir))


def test_detail_starts_from_every_label(spark, sf_dir):
    matched = catalog.label_matches(spark, sf_dir).orderBy("trip_id").limit(100).join(P.scored(spark, sf_dir).select("trip_id", "fare_amount"), "trip_id")
    shown = catalog.matched_detail(spark, sf_dir).select("fare_amount").collect()
    assert sorted(r.fare_amount for r in shown) == sorted(r.fare_amount for r in matched.collect())
    assert sorted(r.trip_id for r in matched.collect()) == _scored_ids(spark, sf_dir)[:100]


def test_detail_flags_take_every_label(spark, sf_dir):
    assert catalog.matched_detail_flags(spark, sf_dir).count() == len(_scored_ids(spark, sf_dir))
