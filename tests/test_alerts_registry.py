import datetime as dt

from pyspark.sql import functions as F

from demandlake.operators import alerts, monitoring, registry

T = dt.datetime(2020, 1, 1)


def test_alert_thresholds(spark):
    d = spark.createDataFrame([("is_promo", 0.25), ("is_promo", 0.26), ("sales_lag_7", 0.26), ("x", None)],
                              "feature string, psi double")
    got = sorted((r["feature"], r["severity"], r["alert_type"]) for r in alerts.drift_alerts(d).collect())
    assert got == [("is_promo", "HIGH", "DRIFT"), ("sales_lag_7", "MEDIUM", "DRIFT")]


def test_severe_flag_and_empty(spark):
    d = spark.createDataFrame([(T, "discount_pct", 0.3), (T, "sales_lag_7", 0.9)],
                              "evaluation_timestamp timestamp, feature string, psi double")
    assert alerts.severe_drift(d).first()["severe_drift"] is True
    assert alerts.severe_drift(d.filter("feature = 'sales_lag_7'")).first()["severe_drift"] is False
    assert alerts.severe_drift(d.filter("false"), by=()).first()["severe_drift"] is False


def test_rollback_truth_table(spark):
    df = spark.createDataFrame([(s, b, c) for s in (True, False) for b, c in ((10.0, 11.0), (10.0, 10.4))],
                               "s boolean, b double, c double")
    got = [r["r"] for r in df.select(alerts.rollback_rule(F.col("s"), F.col("b"), F.col("c")).alias("r")).collect()]
    assert got == [True, False, False, False]


def test_champion_margin(spark):
    per_role = spark.createDataFrame([("BASELINE", "b1"), ("CHALLENGER", "c1")], "model_role string, run_id string")
    for c_mae, want in ((9.5, ("BASELINE", "b1")), (9.49, ("CHALLENGER", "c1"))):
        maes = spark.createDataFrame([(10.0, c_mae)], "baseline_mae double, challenger_mae double")
        r = registry.champion(maes, per_role).first()
        assert (r["active_model"], r["model_run_id"]) == want


def test_latest_per_role_ties(spark):
    runs = spark.createDataFrame(
        [("r1", T, "BASELINE", 1.0), ("r2", T, "BASELINE", 2.0), ("r0", T + dt.timedelta(1), "CHALLENGER", 3.0),
         ("r9", T, "CHALLENGER", 4.0)],
        "run_id string, start_time timestamp, model_role string, mae double")
    got = {r["model_role"]: r["run_id"] for r in registry.latest_per_role(runs).collect()}
    assert got == {"BASELINE": "r2", "CHALLENGER": "r0"}
    assert registry.latest_run(runs).first()["run_id"] == "r0"


def test_active_pointer_and_lookup(spark):
    dec = spark.createDataFrame([("BASELINE", "r1", None, T), ("CHALLENGER", "r2", None, T + dt.timedelta(1))],
                                "active_model string, model_run_id string, reason string, decision_timestamp timestamp")
    runs = spark.createDataFrame([("r1", 1.0), ("r2", 2.0)], "run_id string, mae double")
    assert registry.active_decision(dec).first()["model_run_id"] == "r2"
    assert registry.active_run(dec, runs).first()["mae"] == 2.0
    restamped = registry.restamp(registry.active_decision(dec), F.lit(T)).first()
    assert restamped["decision_timestamp"] == T and restamped["active_model"] == "CHALLENGER"


def test_thresholds_are_arguments(spark):
    d = spark.createDataFrame([("is_promo", 0.22), ("discount_pct", 0.19)], "feature string, psi double")
    assert alerts.drift_alerts(d).count() == 0
    assert [r["feature"] for r in alerts.drift_alerts(d, threshold=0.20).collect()] == ["is_promo"]
    assert alerts.severe_drift(d, by=(), threshold=0.20).first()["severe_drift"] is True
    df = spark.createDataFrame([(10.0, 10.3)], "b double, a double")
    for factor, want in ((1.05, "OK"), (1.02, "DEGRADED")):
        assert df.select(monitoring.degradation_status(F.col("b"), F.col("a"), factor).alias("s")).first()["s"] == want
