import numpy as np
import pytest
from pyspark.sql import functions as F

from meterhawk.operators import quantiles as QU
from meterhawk.operators import scaler as SC
from meterhawk.operators.quantiles import exact_quantiles, medians, threshold

PROBS = [0.0, 0.25, 0.5, 0.75, 0.975, 1.0]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of one column is a single value; another is heavy-tailed; the last has gaps."""
    df = spark.range(30_000, numPartitions=5).select(
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.rand(1) * 10).alias("tied"),
        F.exp(F.randn(2) * 4).alias("tail"),
        F.when(F.col("id") % 7 != 0, (F.col("id") % 10).cast("double")).alias("gaps"),
    )
    return df.persist()


@pytest.mark.parametrize("slots", [128, 24, 2])
def test_quantiles_are_exact(spark, skewed, slots, monkeypatch):
    monkeypatch.setattr(QU, "SLOTS_PER_PASS", slots)
    got = exact_quantiles(skewed, ["tied", "tail", "gaps"], PROBS)
    pdf = skewed.toPandas()
    for c in pdf:
        want = np.nanpercentile(pdf[c], [100 * p for p in PROBS])
        assert got[c] == pytest.approx(want, rel=1e-12)


def test_nan_and_null_are_left_out(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "x double")
    assert medians(df, ["x"]) == {"x": 2.0}


def test_empty_column_has_no_quantile(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "x double, y double")
    assert threshold(df, "x", 0.5) is None
    assert exact_quantiles(df, ["x", "y"], [0.5]) == {"x": [None], "y": [1.5]}
    assert exact_quantiles(df.limit(0), ["x", "y"], [0.5]) == {"x": [None], "y": [None]}


def test_infinities_and_signed_zeros(spark):
    inf = float("inf")
    values = [-inf, -inf, -1e-320, -0.0, 0.0, 5e-324, 1.5, inf, float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    got = exact_quantiles(df, ["x"], [0.0, 1 / 7, 2 / 7, 3 / 7, 4 / 7, 5 / 7, 6 / 7, 1.0])["x"]
    assert got == [-inf, -inf, -1e-320, 0.0, 0.0, 5e-324, 1.5, inf]
    assert np.signbit(got[3:5]).tolist() == [False, False]


def test_ordered_bits_keep_the_order():
    values = np.array([-np.inf, -1e300, -2.0, -5e-324, 0.0, 5e-324, 1.0, np.nextafter(1.0, 2.0), 1e300, np.inf])
    bits = QU.ordered_bits(values)
    assert (np.diff(bits.astype(object)) > 0).all() and QU.ordered_values(bits).tolist() == values.tolist()
    assert QU.ordered_bits(np.array([-0.0])) == QU.ordered_bits(np.array([0.0]))


def test_quantiles_do_not_depend_on_size_or_partitioning(spark):
    """A third of a million rows, more than half of them one value."""
    df = spark.range(350_000, numPartitions=6).select(F.when(F.col("id") % 9 < 5, 7.25).otherwise(F.sqrt("id") - 200).alias("x"), (F.col("id") % 3).alias("n"))
    values = np.array([7.25 if i % 9 < 5 else np.sqrt(i) - 200 for i in range(350_000)])
    want = np.percentile(values, [100 * p for p in PROBS])
    for frame in (df, df.repartition(13, "n")):
        assert exact_quantiles(frame, ["x", "n"], PROBS)["x"] == pytest.approx(want, rel=1e-12)


def test_coarse_distribution_counts_every_row(spark, skewed):
    found = QU.coarse_distribution(skewed, ["tail", "gaps"])
    values = skewed.toPandas()
    for c, (low, high, counts) in found.items():
        held = values[c].dropna().to_numpy()
        assert counts.sum() == len(held) and (low[1:] > high[:-1]).all()
        assert all(((held >= a) & (held <= b)).sum() == n for a, b, n in zip(low, high, counts))
        assert QU.coarse_quantiles(found[c], [0.5])[0] == pytest.approx(np.median(held), rel=0.08, abs=1e-9)


def test_scaler(spark):
    df = spark.createDataFrame([(float(i), 0.0) for i in range(1, 6)], "x double, flag double")
    scaler = SC.fit_scaler(df, ["x", "flag"])
    assert (scaler.center, scaler.scale) == ([3.0, 0.0], [2.0, 1.0])
    assert [r.x for r in SC.scale(df, scaler).collect()] == [-1.0, -0.5, 0.0, 0.5, 1.0]


def test_imputation_fills_null_and_nan_beside_the_original(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "x double")
    got = SC.impute_median(df, ["x"], "m_").collect()
    assert [r.m_x for r in got] == [1.0, 2.0, 2.0, 3.0]
    assert got[2].x is None
