import datetime as dt

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demandlake import config
from demandlake.operators import monitoring, slices

MAX = dt.date(2020, 6, 30)


def test_window_bounds(spark):
    days = [0, 30, 31, 90, 91]
    df = spark.createDataFrame([(MAX - dt.timedelta(d), d) for d in days], "date date, age int")
    cur = {r["age"] for r in slices.since(df, 30).collect()}
    train, test = slices.split_holdout(df, 90)
    assert cur == {0, 30}
    assert {r["age"] for r in test.collect()} == {0, 30, 31, 90}
    assert {r["age"] for r in train.collect()} == {91}
    counts = slices.split_counts(df, 90).first()
    assert (counts["train_rows"], counts["test_rows"]) == (1, 4)


def test_latest_slice_and_guard(spark):
    df = spark.createDataFrame([(MAX, 1), (MAX, 2), (MAX - dt.timedelta(1), 3)], "date date, v int")
    assert sorted(r["v"] for r in slices.latest_slice(df).collect()) == [1, 2]
    with pytest.raises(RuntimeError):
        slices.require_rows(df.filter("v > 10"))


def test_complete_rows_drops_nan(spark):
    df = spark.createDataFrame([(1.0, 1), (float("nan"), 2), (None, 3), (2.0, None)], "x double, y int")
    assert [r["x"] for r in slices.complete_rows(df, ["x", "y"]).collect()] == [1.0]


def _numpy_psi(ref, cur, bins=10):
    e, edges = np.histogram(ref, bins=bins)
    a, _ = np.histogram(cur, bins=edges)
    e = e / len(ref)
    a = a / len(cur)
    return float(np.sum((e - a) * np.log((e + 1e-6) / (a + 1e-6))))


def _psi(spark, ref, cur):
    r = spark.createDataFrame([(float(v),) for v in ref], "x double")
    c = spark.createDataFrame([(float(v),) for v in cur], "x double")
    h = monitoring.histogram(r, c, ["x"])
    return h, monitoring.psi_from_histogram(h).first()["psi"]


def test_psi_identity(spark):
    _, p = _psi(spark, [1, 2, 3, 4, 5, 6], [1, 2, 3, 4, 5, 6])
    assert p == 0.0


def test_psi_out_of_range_counts_in_denominator(spark):
    h, p = _psi(spark, [0, 10], [-5, 0, 10, 20])
    rows = {r["bin"]: (r["n_cur"], r["cur_share"]) for r in h.collect()}
    assert rows[0] == (1, 0.25) and rows[9] == (1, 0.25)
    assert abs(p - _numpy_psi([0, 10], [-5, 0, 10, 20])) < 1e-12


def test_psi_constant_feature(spark):
    h, p = _psi(spark, [2.0, 2.0, 2.0], [2.0])
    assert p == 0.0
    assert h.filter("n_ref > 0").select("bin").first()["bin"] == 5  # 2.0 is edge 5 of 1.5..2.5


def test_psi_empty_current_is_null(spark):
    _, p = _psi(spark, [1, 2, 3], [])
    assert p is None


@settings(max_examples=12, deadline=None)
@given(st.lists(st.floats(-50, 50, allow_nan=False), min_size=2, max_size=80),
       st.lists(st.floats(-60, 60, allow_nan=False), min_size=1, max_size=80))
def test_psi_equals_numpy(spark, ref, cur):
    _, p = _psi(spark, ref, cur)
    assert abs(p - _numpy_psi(ref, cur)) <= 1e-9 * max(1.0, abs(p))


def test_degradation_status(spark):
    df = spark.createDataFrame([(10.0, 10.4), (10.0, 10.6), (0.0, 0.0), (0.0, 1.0)], "b double, a double")
    got = df.select(monitoring.degradation_status(F.col("b"), F.col("a"), 1.05).alias("s")).collect()
    assert [r["s"] for r in got] == ["OK", "DEGRADED", "OK", "DEGRADED"]


def test_performance_frame_schema(spark):
    from demandlake.sources import schemas
    maes = spark.createDataFrame([(10.0, 10.6)], "baseline_mae double, active_model_mae double")
    row = schemas.conform(
        monitoring.performance_frame(maes, F.lit("CHALLENGER"), F.current_timestamp()), schemas.PERFORMANCE
    ).first()
    assert row["status"] == "DEGRADED" and abs(row["degradation_pct"] - 0.06) < 1e-12


def test_drift_sides_single_scan(spark):
    rows = [(MAX - dt.timedelta(d), 1, 0.1, 1, 1, 1, 1.0, 1.0) for d in (0, 10, 50, 100, 200)]
    g = spark.createDataFrame(rows, "date date, is_promo int, discount_pct double, sales_lag_7 int, "
                                    "sales_lag_14 int, sales_lag_28 int, sales_roll_mean_7 double, sales_roll_mean_28 double")
    sides = {r["side"] for r in monitoring.drift_sides(g, config.DRIFT_FEATURES).collect()}
    assert sides == {"ref", "cur"}
    assert monitoring.drift_sides(g).count() == 4  # day 50 belongs to neither window


def test_psi_on_gold_equals_numpy_histogram(spark):
    """Brute force on the small fixture: numpy's histogram-based PSI over
    the same reference/current windows equals the distributed plan."""
    from demandlake.plans import catalog

    g = catalog._gold_table(spark, "/root/testdata/sf0.001")
    ref, cur = monitoring.drift_windows(g)
    ref_pd, cur_pd = ref.toPandas(), cur.toPandas()  # small test fixture only
    got = {r["feature"]: r["psi"] for r in monitoring.feature_psi(g).collect()}
    for f in config.DRIFT_FEATURES:
        want = _numpy_psi(ref_pd[f].to_numpy(float), cur_pd[f].to_numpy(float))
        assert abs(got[f] - want) <= 1e-12 * max(1.0, abs(want)), f
