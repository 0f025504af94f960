"""Registered queries: one per operator group, each ``(spark, sf_dir) ->
DataFrame`` over the whole driver tables.

Floating-point aggregates whose summation order is engine-dependent are
rounded to 6 decimals here (and identically in the SQL oracle); row-level
arithmetic is left exact.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.stat import Summarizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake import config
from demandlake.functions import columns as C
from demandlake.operators import alerts, bronze, checks, gold, models, monitoring, registry, silver, slices
from demandlake.plans import fixtures as fx
from demandlake.plans import flows
from demandlake.plans import params as P
from demandlake.sources import io, schemas, storage
from demandlake.sources.versioned import VersionedTable

_GOLD_ROOTS: dict[tuple, str] = {}

Query = Callable[[SparkSession, str], DataFrame]


def _r(c, name: str | None = None, digits: int = 6):
    col = F.round(F.col(c) if isinstance(c, str) else c, digits)
    return col.alias(name or (c if isinstance(c, str) else None))


def _wall_clock(df: DataFrame, *cols: str) -> DataFrame:
    """Contract timestamps (session-zone TIMESTAMP) back to zone-free
    wall-clock values: the round trip through one session zone is exact,
    so results do not depend on the zone of the process that collects."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


# ---------------------------------------------------------------- inputs

def _silver(spark, sf) -> DataFrame:
    return silver.build_silver(fx.bronze_dirty(spark, sf), as_of=P.day(P.AS_OF), tie_breakers=fx.dirty_tie_breakers())


def _gold(spark, sf) -> DataFrame:
    """The flagship input: dirty bronze -> clean -> dedup -> features."""
    return gold.build_features(_silver(spark, sf))


def _gold_table(spark, sf) -> slices.Dated:
    """The gold layer, written once per application and state of the input
    files (by month, like the flows' lake) and read by all later queries: the
    downstream steps (slices, models, drift) scan the table, as in production."""
    key = (spark.sparkContext.applicationId, sf, *(storage.fingerprint(spark, f"{sf}/{t}.parquet") for t in fx.SALES_TABLES))
    if key not in _GOLD_ROOTS:
        root = storage.scratch_path(spark, "gold")
        flows.Lake(spark, root).write_layer(_gold(spark, sf), "gold_sales_features")
        _GOLD_ROOTS[key] = root
    return flows.Lake(spark, _GOLD_ROOTS[key]).dated("gold_sales_features")


def _int_keys(spark, sf) -> DataFrame:
    li = fx.table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.col("l_suppkey").cast("int").alias("store"),
        F.col("l_partkey").cast("int").alias("item"),
        F.col("l_shipdate").cast("date").alias("date"),
    )


def _typed(spark, sf) -> DataFrame:
    return bronze.type_sales(fx.raw_strings(spark, sf))


def _complete_features(df: DataFrame) -> DataFrame:
    return df.select("date", "store", "item", config.TARGET, *config.FEATURES).dropna(how="any")


def _fixed_scores(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "pred_baseline": C.linear_score(P.BASELINE_COEF, P.BASELINE_INTERCEPT),
        "pred_challenger": C.linear_score(P.CHALLENGER_COEF, P.CHALLENGER_INTERCEPT),
    })


def _eval_maes(spark, sf) -> DataFrame:
    """Last-30-day MAEs of the two constant scorers (one row)."""
    ev = _complete_features(slices.since(_gold_table(spark, sf), config.EVAL_DAYS))
    return models.mae_by(_fixed_scores(ev), {"baseline_mae": "pred_baseline", "challenger_mae": "pred_challenger"})


def _train_matrix(spark, sf) -> DataFrame:
    train, _ = slices.split_holdout(_gold_table(spark, sf))
    return models.feature_matrix(train)


# ------------------------------------------------------- sources / sinks

def csv_scan(spark, sf):
    path = storage.scratch_path(spark, "raw_sales_csv")
    fx.sales_facts(spark, sf).write.option("header", True).csv(path)
    return io.read_raw_sales(spark, path)


def table_scan(spark, sf):
    return io.read_table(spark, sf, "orders")


def append_readback(spark, sf):
    path = storage.scratch_path(spark, "sales_append")
    facts = fx.sales_facts(spark, sf)
    io.write_table(facts, path, "append")
    io.write_table(facts, path, "append")
    return io.read_back(spark, path)


def overwrite_readback(spark, sf):
    path = storage.scratch_path(spark, "sales_overwrite")
    io.write_table(fx.bronze_dirty(spark, sf), path, "overwrite")
    io.write_table(fx.sales_facts(spark, sf), path, "overwrite")
    return io.read_back(spark, path)


def _bronze_two_loads(spark, sf) -> DataFrame:
    """Two loads of the same raw rows: without, then with promo columns."""
    path = storage.scratch_path(spark, "bronze_sales")
    raw = fx.raw_strings(spark, sf)
    io.write_table(bronze.ingest(raw, P.ts(P.LOAD_TS), with_promo=False), path, "append")
    io.write_table(bronze.ingest(raw, P.ts(P.LOAD_TS_2), with_promo=True), path, "append", evolve=True)
    return io.read_back(spark, path, merge_schema=True)


def bronze_evolved(spark, sf):
    return _bronze_two_loads(spark, sf)


def schema_description(spark, sf):
    return schemas.profile(_bronze_two_loads(spark, sf))


# ------------------------------------------------- projections / filters

def raw_typed(spark, sf):
    return _typed(spark, sf)


def date_shifted(spark, sf):
    return bronze.shift_dates(_typed(spark, sf))


def ingest_stamped(spark, sf):
    return bronze.stamp(bronze.shift_dates(_typed(spark, sf)), P.ts(P.LOAD_TS))


def promo_bucket(spark, sf):
    return bronze.promo_bucket(_int_keys(spark, sf), ("store", "item", "date"), "bucket")


def promo_assigned(spark, sf):
    return bronze.assign_promo(_int_keys(spark, sf), ("store", "item", "date"))


def clean_sales(spark, sf):
    return silver.clean(fx.bronze_dirty(spark, sf), as_of=P.day(P.AS_OF))


def silver_latest(spark, sf):
    return _silver(spark, sf)


def calendar_features(spark, sf):
    return gold.calendar_features(_silver(spark, sf))


def lag_features(spark, sf):
    return gold.lag_features(_silver(spark, sf))


def rolling_means(spark, sf):
    return gold.rolling_means(_silver(spark, sf))


def gold_features(spark, sf):
    return _gold(spark, sf)


def gold_projection(spark, sf):
    """The whole chain on clean facts: stamp, hash promo, clean, dedup,
    features, explicit 14-column projection."""
    facts = bronze.assign_promo(bronze.stamp(fx.sales_facts(spark, sf), P.ts(P.LOAD_TS)))
    return gold.build_features(silver.build_silver(facts, as_of=P.day(P.AS_OF)))


# ------------------------------------------------------------- slices

def train_test_counts(spark, sf):
    return slices.split_counts(_gold_table(spark, sf))


def eval_window(spark, sf):
    """The slice is written once; the guard looks at what was written."""
    ev = slices.since(_gold_table(spark, sf), config.EVAL_DAYS).select(*config.GOLD_COLUMNS).dropna(how="any")
    return slices.require_rows(io.materialize(ev, storage.scratch_path(spark, "eval_window")), "evaluation")


def latest_date_slice(spark, sf):
    return slices.latest_slice(_gold_table(spark, sf))


def latest_batch_slice(spark, sf):
    return slices.latest_slice(fx.drift_batches(spark, sf), "evaluation_timestamp")


def complete_rows(spark, sf):
    return slices.complete_rows(_gold(spark, sf), [*config.FEATURES, config.TARGET])


# --------------------------------------------------------- aggregates

def date_bounds(spark, sf):
    return checks.date_bounds(_gold_table(spark, sf).stats)


def ts_bounds(spark, sf):
    return fx.bronze_dirty(spark, sf).agg(
        F.min("ingestion_timestamp").alias("min_ts"), F.max("ingestion_timestamp").alias("max_ts")
    )


def promo_summary(spark, sf):
    return checks.promo_summary(bronze.assign_promo(_int_keys(spark, sf)))


def silver_totals(spark, sf):
    return checks.sales_totals(_silver(spark, sf))


def model_versions(spark, sf):
    d = fx.model_decisions(spark, sf)
    return d.agg(F.count(F.lit(1)).alias("decision_rows"), F.count_distinct("model_run_id").alias("model_versions"))


def null_lag_rows(spark, sf):
    return checks.null_count(_gold_table(spark, sf).stats, "sales_lag_7", "rows_with_null_lag")


def max_date(spark, sf):
    return _gold_table(spark, sf).stats.agg(F.max("date").alias("max_date"))


def layer_checks(spark, sf):
    """Each layer is built and written once, and checked while written."""
    lake = flows.Lake(spark, storage.scratch_path(spark, "checked_lake"))
    rows, taken = checks.observed(fx.bronze_dirty(spark, sf), "bronze")
    with io.dealt_by_size(rows):
        io.write_table(rows, lake.path("bronze_sales"), "overwrite")
    lake.note_checks("bronze", taken.get)
    s = silver.build_silver(lake.read("bronze_sales"), as_of=P.day(P.AS_OF), tie_breakers=fx.dirty_tie_breakers())
    lake.write_layer(s, "silver_sales", check="silver")
    lake.write_layer(gold.build_features(lake.layer("silver_sales")), "gold_sales_features", check="gold")
    return lake.read("layer_checks")


def tables_by_name(spark, sf):
    """Two appends to a table by name and a dated layer, both reached by SQL
    through the catalog: sales by month, with the rows of the named table."""
    name = f"named_silver_{uuid.uuid4().hex}"
    s = _silver(spark, sf).select("date", "store", "item", "sales", "is_promo")
    s = io.materialize(s, storage.scratch_path(spark, "silver_once"))  # three writes read it
    path = storage.scratch_path(spark, "named_silver")
    io.save_named(s.filter("is_promo = 1"), name, path)
    io.save_named(s.filter("is_promo = 0"), name, path)
    prefix = f"lake_{uuid.uuid4().hex}_"
    lake = flows.Lake(spark, storage.scratch_path(spark, "named_lake"))
    lake.write_layer(s, "silver_sales")
    lake.register(["silver_sales"], prefix)
    return spark.sql(f"""
        SELECT l.storage_month, l.total_sales, n.promo_rows
        FROM (SELECT storage_month, sum(sales) AS total_sales FROM {prefix}silver_sales GROUP BY storage_month) l
        JOIN (SELECT date_format(date, 'yyyy-MM') AS storage_month, sum(is_promo) AS promo_rows FROM {name} GROUP BY 1) n
          ON l.storage_month = n.storage_month""")


# ------------------------------------------------------------- models

def fixed_linear_scores(spark, sf):
    latest = slices.latest_slice(_gold_table(spark, sf))
    rows = latest.select("date", "store", "item", *config.FEATURES).dropna(how="any")
    return rows.select(
        "*",
        C.linear_score(P.BASELINE_COEF, P.BASELINE_INTERCEPT).alias("predicted_sales"),
        F.lit(P.FIXED_BASELINE_RUN).alias("model_run_id"),
        F.lit(config.BASELINE).alias("model_role"),
        P.ts(P.EVAL_TS).alias("prediction_timestamp"),
    )


def forecast_checks(spark, sf):
    """Two forecast batches (two scorers, two stamps) appended to a forecast
    table; then rows, distinct run ids and the prediction-time range."""
    path = storage.scratch_path(spark, "gold_sales_forecast")
    latest = slices.latest_slice(_gold_table(spark, sf))
    rows = latest.select("date", "store", "item", *config.FEATURES).dropna(how="any")
    for coef, icpt, run, role, stamp in (
        (P.BASELINE_COEF, P.BASELINE_INTERCEPT, P.FIXED_BASELINE_RUN, config.BASELINE, P.EVAL_TS),
        (P.CHALLENGER_COEF, P.CHALLENGER_INTERCEPT, P.FIXED_CHALLENGER_RUN, config.CHALLENGER, P.EVAL_TS_2),
    ):
        batch = rows.select(
            "*",
            C.linear_score(coef, icpt).alias("predicted_sales"),
            F.lit(run).alias("model_run_id"),
            F.lit(role).alias("model_role"),
            P.ts(stamp).alias("prediction_timestamp"),
        )
        io.write_table(batch, path, "append")
    fc = io.read_back(spark, path)
    return fc.agg(
        F.count(F.lit(1)).alias("forecast_rows"),
        F.count_distinct("model_run_id").alias("model_versions"),
        F.min("prediction_timestamp").alias("min_prediction_timestamp"),
        F.max("prediction_timestamp").alias("max_prediction_timestamp"),
    )


def forecast_mae_rmse(spark, sf):
    _, test = slices.split_holdout(_gold_table(spark, sf))
    scored = _complete_features(test).withColumn(
        "predicted_sales", C.linear_score(P.BASELINE_COEF, P.BASELINE_INTERCEPT)
    )
    m = models.error_metrics(scored)
    return m.select("n_rows", _r("mae"), _r("rmse"))


def feature_matrix_stats(spark, sf):
    m = _train_matrix(spark, sf)
    s = m.select(Summarizer.metrics("count", "sum", "min", "max").summary(F.col("features")).alias("s"))
    arr = s.select(
        F.col("s.count").alias("n_rows"),
        vector_to_array(F.col("s.sum")).alias("sums"),
        vector_to_array(F.col("s.min")).alias("mins"),
        vector_to_array(F.col("s.max")).alias("maxs"),
    )
    names = F.array(*[F.lit(f) for f in config.FEATURES])
    z = arr.select("n_rows", F.posexplode(names).alias("i", "feature"), "sums", "mins", "maxs")
    return z.select(
        "feature", "n_rows",
        _r(F.col("sums")[F.col("i")], "col_sum"),
        F.col("mins")[F.col("i")].alias("col_min"),
        F.col("maxs")[F.col("i")].alias("col_max"),
    )


def ols_normal_equations(spark, sf):
    m = _train_matrix(spark, sf)
    model = models.fit_baseline(m)
    return models.normal_equation_check(model, m)


def forest_invariants(spark, sf):
    m = _train_matrix(spark, sf)
    model = models.fit_challenger(m, num_trees=100, max_depth=10, seed=42)
    return models.forest_check(model, m)


def model_comparison(spark, sf):
    m = _eval_maes(spark, sf)
    return m.select(_r("baseline_mae"), _r("challenger_mae"))


# ------------------------------------------------------------- drift

def _sides(spark, sf):
    return monitoring.drift_sides(_gold_table(spark, sf))


def feature_histogram(spark, sf):
    return monitoring.histogram_sides(_sides(spark, sf))


def feature_psi(spark, sf):
    p = monitoring.feature_psi(_gold_table(spark, sf))
    return p.select("feature", _r("psi"))


def drift_metrics(spark, sf):
    path = storage.scratch_path(spark, "feature_drift_metrics")
    d = monitoring.drift_metrics(_gold_table(spark, sf), P.ts(P.EVAL_TS))
    io.write_table(d, path, "append")
    return io.read_back(spark, path).select("feature", _r("psi"), "evaluation_timestamp")


def _latest_batch(spark, sf):
    return slices.latest_slice(fx.drift_batches(spark, sf), "evaluation_timestamp")


def drift_alerts(spark, sf):
    return alerts.drift_alerts(_latest_batch(spark, sf), P.ts(P.EVAL_TS))


def severe_drift(spark, sf):
    return alerts.severe_drift(fx.drift_batches(spark, sf))


def alerts_published(spark, sf):
    """The table holds the alerts of the whole history when it is reset."""
    path = storage.scratch_path(spark, "ml_alerts")
    history = fx.drift_batches(spark, sf)
    alerts.publish_alerts(spark, alerts.drift_alerts(history, F.col("evaluation_timestamp")), path, keep_history=True)
    a = alerts.drift_alerts(_latest_batch(spark, sf), P.ts(P.EVAL_TS))
    return _wall_clock(alerts.publish_alerts(spark, a, path), "alert_timestamp")


# ---------------------------------------------------------- registry

def run_roundtrip(spark, sf):
    train, test = slices.split_holdout(_gold_table(spark, sf))
    model = models.fit_baseline(models.feature_matrix(train))
    test_m = models.feature_matrix(test)
    metrics = models.error_metrics(models.score(model, test_m)).first()
    runs_path = storage.scratch_path(spark, "model_runs")
    run_id = registry.record_run(
        spark, runs_path, model, config.BASELINE, P.ENV, metrics["mae"], metrics["rmse"],
        params={"holdout_days": str(config.HOLDOUT_DAYS)},
    )
    runs = io.read_back(spark, runs_path)
    loaded = registry.load_run_model(runs.filter(F.col("run_id") == run_id))
    saved = model.transform(test_m).withColumnRenamed("prediction", "p_saved")
    both = loaded.transform(saved).withColumnRenamed("prediction", "p_loaded")
    return both.agg(
        F.lit(models.LINEAR).alias("model_type"),
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.max(F.abs(F.col("p_saved") - F.col("p_loaded"))), F.lit(0.0)).alias("max_abs_diff"),
    )


def latest_run(spark, sf):
    return registry.latest_run(fx.model_runs(spark, sf))


def latest_run_per_role(spark, sf):
    return registry.latest_per_role(registry.runs_for_env(fx.model_runs(spark, sf), P.ENV))


def active_model(spark, sf):
    return registry.active_decision(fx.model_decisions(spark, sf))


def active_run_lookup(spark, sf):
    return registry.active_run(fx.model_decisions(spark, sf), fx.model_runs(spark, sf))


def decision_history(spark, sf):
    return registry.ordered_history(fx.model_decisions(spark, sf), "decision_timestamp")


def _champion(spark, sf):
    per_role = registry.latest_per_role(registry.runs_for_env(fx.model_runs(spark, sf), P.ENV))
    return registry.champion(_eval_maes(spark, sf), per_role)


def champion_decision(spark, sf):
    c = _champion(spark, sf)
    return c.select("active_model", "model_run_id", _r("baseline_mae"), _r("challenger_mae"))


def decision_written(spark, sf):
    path = storage.scratch_path(spark, "model_decisions")
    io.write_table(schemas.conform(fx.model_decisions(spark, sf), schemas.MODEL_DECISIONS), path, "overwrite")
    rows = registry.decision_rows(_champion(spark, sf), ts=P.ts(P.EVAL_TS))
    return _wall_clock(registry.append_decisions(spark, rows, path), "decision_timestamp")


def _active_maes(spark, sf) -> DataFrame:
    role = registry.active_decision(fx.model_decisions(spark, sf)).select("active_model").scalar()
    m = _eval_maes(spark, sf)
    return m.select(
        role.alias("active_model"),
        F.col("baseline_mae"),
        F.when(role == config.CHALLENGER, F.col("challenger_mae")).otherwise(F.col("baseline_mae")).alias("active_model_mae"),
    )


def degradation_status(spark, sf):
    m = _active_maes(spark, sf)
    b, a = F.col("baseline_mae"), F.col("active_model_mae")
    return m.select(
        "active_model",
        _r(b, "baseline_mae"),
        _r(a, "active_model_mae"),
        _r(monitoring.degradation(b, a), "degradation_pct"),
        monitoring.degradation_status(b, a, config.ALERT_ROLLBACK_FACTOR).alias("status"),
    )


def performance_row(spark, sf):
    path = storage.scratch_path(spark, "model_performance_metrics")
    m = _active_maes(spark, sf)
    row = monitoring.performance_frame(m, F.col("active_model"), P.ts(P.EVAL_TS), config.ALERT_ROLLBACK_FACTOR)
    io.write_table(schemas.conform(row, schemas.PERFORMANCE), path, "append")
    back = io.read_back(spark, path)
    return back.select(
        "active_model", _r("baseline_mae"), _r("active_model_mae"), _r("degradation_pct"), "status",
        F.col("evaluation_timestamp").cast("timestamp_ntz").alias("evaluation_timestamp"),
    )


def _rollback_frame(spark, sf) -> DataFrame:
    per_role = registry.latest_per_role(registry.runs_for_env(fx.model_runs(spark, sf), P.ENV))
    piv = registry.role_pivot(per_role, "mae")
    b_mae = piv.select("baseline_mae").scalar()
    c_mae = piv.select("challenger_mae").scalar()
    b_run = piv.select("baseline_run_id").scalar()
    sev = alerts.severe_drift(fx.drift_batches(spark, sf))
    return sev.select(
        "evaluation_timestamp",
        "severe_drift",
        b_run.alias("baseline_run_id"),
        b_mae.alias("baseline_mae"),
        c_mae.alias("challenger_mae"),
        alerts.rollback_rule(F.col("severe_drift"), b_mae, c_mae).alias("rollback_required"),
    )


def rollback_decision(spark, sf):
    return _rollback_frame(spark, sf).select(
        "evaluation_timestamp", "severe_drift", _r("baseline_mae"), _r("challenger_mae"), "rollback_required"
    )


def pointer_after_rollback(spark, sf):
    """Pointer log + a rollback row when the latest severe batch demands it,
    then the active pointer."""
    path = storage.scratch_path(spark, "model_decisions")
    io.write_table(schemas.conform(fx.model_decisions(spark, sf), schemas.MODEL_DECISIONS), path, "overwrite")
    rb = _rollback_frame(spark, sf).filter(F.col("severe_drift"))
    chosen = slices.latest_slice(rb, "evaluation_timestamp").filter(F.col("rollback_required"))
    rows = registry.decision_rows(
        chosen.select(F.lit(config.BASELINE).alias("active_model"), F.col("baseline_run_id").alias("model_run_id")),
        ts=P.ts(P.EVAL_TS), reason=F.lit("AUTO_ROLLBACK"),
    )
    log = registry.append_decisions(spark, rows, path)
    return _wall_clock(registry.active_decision(log), "decision_timestamp")


def pointer_restamped(spark, sf):
    """The pointer table is written, overwritten from itself, read back."""
    table = VersionedTable(spark, storage.scratch_path(spark, "active_model_pointer"), schemas.MODEL_DECISIONS)
    table.replace(schemas.conform(registry.active_decision(fx.model_decisions(spark, sf)), schemas.MODEL_DECISIONS))
    return _wall_clock(registry.restamp_table(table, P.ts(P.EVAL_TS)), "decision_timestamp")


QUERIES: dict[str, Query] = {
    "csv_scan": csv_scan,
    "table_scan": table_scan,
    "append_readback": append_readback,
    "overwrite_readback": overwrite_readback,
    "schema_description": schema_description,
    "raw_typed": raw_typed,
    "date_shifted": date_shifted,
    "ingest_stamped": ingest_stamped,
    "promo_bucket": promo_bucket,
    "promo_assigned": promo_assigned,
    "bronze_evolved": bronze_evolved,
    "clean_sales": clean_sales,
    "silver_latest": silver_latest,
    "calendar_features": calendar_features,
    "lag_features": lag_features,
    "rolling_means": rolling_means,
    "gold_features": gold_features,
    "gold_projection": gold_projection,
    "train_test_counts": train_test_counts,
    "eval_window": eval_window,
    "latest_date_slice": latest_date_slice,
    "latest_batch_slice": latest_batch_slice,
    "complete_rows": complete_rows,
    "date_bounds": date_bounds,
    "ts_bounds": ts_bounds,
    "promo_summary": promo_summary,
    "silver_totals": silver_totals,
    "model_versions": model_versions,
    "null_lag_rows": null_lag_rows,
    "max_date": max_date,
    "layer_checks": layer_checks,
    "tables_by_name": tables_by_name,
    "fixed_linear_scores": fixed_linear_scores,
    "forecast_checks": forecast_checks,
    "forecast_mae_rmse": forecast_mae_rmse,
    "feature_matrix_stats": feature_matrix_stats,
    "ols_normal_equations": ols_normal_equations,
    "forest_invariants": forest_invariants,
    "model_comparison": model_comparison,
    "feature_histogram": feature_histogram,
    "feature_psi": feature_psi,
    "drift_metrics": drift_metrics,
    "drift_alerts": drift_alerts,
    "severe_drift": severe_drift,
    "alerts_published": alerts_published,
    "run_roundtrip": run_roundtrip,
    "latest_run": latest_run,
    "latest_run_per_role": latest_run_per_role,
    "active_model": active_model,
    "active_run_lookup": active_run_lookup,
    "decision_history": decision_history,
    "champion_decision": champion_decision,
    "decision_written": decision_written,
    "degradation_status": degradation_status,
    "performance_row": performance_row,
    "rollback_decision": rollback_decision,
    "pointer_after_rollback": pointer_after_rollback,
    "pointer_restamped": pointer_restamped,
}
