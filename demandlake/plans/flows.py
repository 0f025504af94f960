"""The two end-to-end flows, as plain functions that call the stages in
order.  Every layer is written once to a table folder below ``root`` and
read back by the next stage, so lineage never spans layers and a lost
executor only costs re-reading files.

Tables (Parquet by default): bronze_sales, silver_sales,
gold_sales_features, gold_sales_forecast, model_runs, model_decisions,
model_performance_metrics, feature_drift_metrics, ml_alerts.

Driver round trips are limited to: model fits (their own distributed jobs),
one metrics row per training run, the model path of a chosen run, one row of
checks per layer, and the names of bronze files not merged yet.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlake import config
from demandlake.operators import alerts, bronze, checks, gold, models, monitoring, registry, silver, slices
from demandlake.sources import io, schemas, storage

TABLES = (
    "bronze_sales", "silver_sales", "gold_sales_features", "gold_sales_forecast", "model_runs",
    "model_decisions", "model_performance_metrics", "feature_drift_metrics", "ml_alerts", "layer_checks",
)
STORAGE_MONTH = "storage_month"


@dataclass
class Lake:
    """Table locations below one root folder."""

    spark: SparkSession
    root: str
    fmt: str = "parquet"

    def path(self, name: str) -> str:
        return io.table_path(self.root, name, self.fmt)

    def read(self, name: str, merge_schema: bool = False) -> DataFrame:
        return io.read_back(self.spark, self.path(name), self.fmt, merge_schema)

    def exists(self, name: str) -> bool:
        if not storage.exists(self.spark, self.path(name)):
            return False
        try:
            self.read(name)
        except AnalysisException as e:
            if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without files
                return False
            raise
        return True

    def dated(self, name: str) -> slices.Dated:
        """A dated layer, with its months and statistics for windows."""
        return slices.Dated(self.read(name), io.statistics(self.spark, self.path(name), self.fmt), STORAGE_MONTH)

    def layer(self, name: str) -> DataFrame:
        """A dated layer as its own columns; the storage month stays behind."""
        return self.read(name).drop(STORAGE_MONTH)

    def write_layer(self, df: DataFrame, name: str, months_only: bool = False, check: str | None = None) -> None:
        """Overwrite a dated layer, or only the months that ``df`` holds.

        Full and incremental refreshes share this one layout, folders by
        month.  The rows are rebalanced by month: Spark measures them and
        splits large months over many tasks and files, and gathers small
        ones, so files follow the bytes of a month.  ``check`` names the
        layer whose checks are taken during this write."""
        w = df.withColumn(STORAGE_MONTH, F.date_format("date", "yyyy-MM")).hint("rebalance", STORAGE_MONTH)
        taken = None
        if check:
            w, taken = checks.observed(w, check)
        out = w.write.format(self.fmt).mode("overwrite").partitionBy(STORAGE_MONTH)
        with io.dealt_by_size(df):
            out.option("partitionOverwriteMode", "dynamic" if months_only else "static").save(self.path(name))
        if taken:
            self.note_checks(check, taken.get)

    def note_checks(self, layer: str, values: dict) -> None:
        io.write_table(checks.check_rows(self.spark, layer, values), self.path("layer_checks"), "append", self.fmt)

    def register(self, names: Sequence[str], prefix: str = "") -> None:
        """Enter tables of this lake in the session's catalog, so SQL reaches
        them by name; entering one again renews it."""
        for name in names:
            table = prefix + name
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")  # an entry only: the files are not the catalog's
            self.spark.catalog.createTable(table, path=self.path(name), source=self.fmt)
            if STORAGE_MONTH in self.spark.table(table).columns:
                self.spark.catalog.recoverPartitions(table)


# ------------------------------------------------------------- training

def ingest_raw(lake: Lake, raw_path: str, ts: Column | None = None) -> None:
    raw = io.read_raw_sales(lake.spark, raw_path)
    rows, taken = checks.observed(bronze.ingest(raw, ts), "bronze")
    io.write_table(rows, lake.path("bronze_sales"), "append", lake.fmt, evolve=True)
    lake.note_checks("bronze", taken.get)


def _files(df: DataFrame) -> dict[str, str]:
    """Path by name of the files of a table as it was opened; names are
    unique, each write makes its own."""
    return {f.rsplit("/", 1)[-1]: f for f in df.inputFiles()}


def _unmerged(lake: Lake, files: dict[str, str]) -> list[str]:
    """Names of the bronze files that no refresh has merged: an anti-join of
    the listing against the ledger.  What comes back is what has arrived
    since, however late it was committed and whatever stamps it holds."""
    if not files:
        return []
    names = lake.spark.createDataFrame([(n,) for n in files], "file string")
    if lake.exists("silver_ledger"):
        names = names.join(lake.read("silver_ledger").select("file"), "file", "left_anti")
    return sorted(r["file"] for r in names.collect())


def refresh_silver(lake: Lake, as_of: Column | None = None, tie_breakers=()) -> None:
    """Rebuild silver from the whole of bronze."""
    b = lake.read("bronze_sales", merge_schema=True)
    files = _files(b)
    day = lake.spark.range(1).select((as_of if as_of is not None else F.current_date()).cast("date")).first()[0]
    order = [F.col("ingestion_timestamp").desc(), *tie_breakers]
    cand = silver.clean(b, F.lit(day))
    lake.write_layer(silver.latest_per_key(cand, config.KEYS, order), "silver_sales", check="silver")
    _note_silver(lake, _unmerged(lake, files), cand, day)


def _silver_state(lake: Lake):
    """The newest state row; None before the first refresh."""
    if not lake.exists("silver_state"):
        return None
    return lake.read("silver_state").orderBy(F.col("refresh_id").desc()).first()


def _note_silver(lake: Lake, merged: list[str], cand: DataFrame, as_of: datetime.date) -> None:
    """Append what a refresh merged: the series it may have changed with
    their first date, the bronze files, and last its state.  Both kinds of
    refresh note it, so they can follow each other in any order; a refresh
    that breaks off before is simply done again, as merging a row twice
    changes nothing."""
    st = _silver_state(lake)
    refresh_id = st["refresh_id"] + 1 if st else 1
    changes = cand.groupBy(*config.SERIES).agg(F.min("date").alias("from_date"))
    io.write_table(changes.withColumn("refresh_id", F.lit(refresh_id).cast("long")), lake.path("silver_changes"), "append", lake.fmt)
    if merged:
        ledger = lake.spark.createDataFrame([(f, refresh_id) for f in merged], "file string, refresh_id long")
        io.write_table(ledger, lake.path("silver_ledger"), "append", lake.fmt)
    row = lake.spark.createDataFrame([(refresh_id, as_of)], "refresh_id long, as_of date")
    io.write_table(row, lake.path("silver_state"), "append", lake.fmt)


def refresh_silver_incremental(
    lake: Lake,
    as_of: datetime.date | None = None,
    tie_breakers=(),
) -> None:
    """Incremental silver maintenance with the same result as a full rebuild.

    Silver is stored by month; the ``silver_ledger`` table holds the bronze
    files already merged, ``silver_state`` the previous ``as_of``.  A run
    reads the files that are not in the ledger, and of the others the rows
    whose date has entered the future-tolerance window since.  They are
    cleaned, merged with the current winners of the months they touch, staged
    in the shared folder, and only those months are overwritten.  ``as_of``
    never moves back.
    """
    spark = lake.spark
    as_of = as_of or datetime.date.today()
    st = _silver_state(lake)
    if st is None:
        refresh_silver(lake, F.lit(as_of), tie_breakers)
        return
    if as_of < st["as_of"]:
        raise ValueError(f"as_of {as_of} is before the previous refresh's {st['as_of']}")
    order = [F.col("ingestion_timestamp").desc(), *tie_breakers]
    b = lake.read("bronze_sales", merge_schema=True)
    files = _files(b)
    pending = _unmerged(lake, files)
    new = spark.read.format(lake.fmt).schema(b.schema).load([files[f] for f in pending]) if pending else b.limit(0)
    if as_of > st["as_of"]:
        last = [F.lit(d) + F.expr(f"INTERVAL {config.FUTURE_TOLERANCE_DAYS} DAY") for d in (st["as_of"], as_of)]
        entering = b.filter((F.col("date") > last[0]) & (F.col("date") <= last[1]))
        new = new.unionByName(entering)  # rows of pending files may come twice, which changes nothing
    cand = silver.clean(new, F.lit(as_of))
    current = lake.read("silver_sales")
    touched = cand.select(F.date_format("date", "yyyy-MM").alias(STORAGE_MONTH)).distinct()
    old = current.join(touched, STORAGE_MONTH, "left_semi").drop(STORAGE_MONTH)
    merged = silver.latest_per_key(old.unionByName(cand, allowMissingColumns=True), config.KEYS, order)
    staged = io.materialize(merged, storage.scratch_path(spark, "silver_staged"))
    lake.write_layer(staged, "silver_sales", months_only=True)
    _note_silver(lake, pending, cand, as_of)


def refresh_gold_incremental(lake: Lake) -> None:
    """Recompute gold only where silver changed, with the same result as a
    full ``gold.build_features`` over silver.

    For each changed series, rows from its first changed date onward are
    recomputed together with a halo of the 28 rows before it (lags and
    trailing means look back at most 28 rows); the halo is a top-28 per
    series, so Spark limits it per task before the shuffle.  Touched months
    are rewritten with the recomputed rows plus the unchanged rows of other
    series and days, staged in the shared folder first.  Keys never leave
    silver, so no month ever needs deleting.
    """
    spark = lake.spark
    if not lake.exists("gold_state"):
        refresh_gold(lake)
        return
    sil = lake.layer("silver_sales")
    last = _silver_state(lake)["refresh_id"]
    changes_all = lake.read("silver_changes")
    done = lake.read("gold_state").agg(F.max("refresh_id").alias("m")).first()["m"]
    ch = (
        changes_all.filter(F.col("refresh_id") > F.lit(done))
        .groupBy(*config.SERIES).agg(F.min("from_date").alias("from_date"))
    )
    if ch.isEmpty():
        return
    halo_n = max(config.LAGS + config.ROLLING)
    sj = sil.join(ch, list(config.SERIES))
    w_back = Window.partitionBy(*config.SERIES).orderBy(F.col("date").desc())
    halo = (
        sj.filter(F.col("date") < F.col("from_date"))
        .withColumn("_rn", F.row_number().over(w_back))
        .filter(F.col("_rn") <= halo_n)
        .drop("_rn")
    )
    tail = sj.filter(F.col("date") >= F.col("from_date"))
    rows = halo.unionByName(tail)  # keeps each series' from_date
    fresh = (
        gold.rolling_means(gold.lag_features(gold.calendar_features(rows)))
        .filter(F.col("date") >= F.col("from_date"))
        .select(*config.GOLD_COLUMNS)
    )
    lo = ch.agg(F.date_format(F.min("from_date"), "yyyy-MM")).scalar()
    old = lake.read("gold_sales_features").filter(F.col(STORAGE_MONTH) >= lo)
    kept = (
        old.join(ch, list(config.SERIES), "left")
        .filter(F.col("from_date").isNull() | (F.col("date") < F.col("from_date")))
        .select(*config.GOLD_COLUMNS)
    )
    staged = io.materialize(kept.unionByName(fresh), storage.scratch_path(spark, "gold_staged"))
    lake.write_layer(staged, "gold_sales_features", months_only=True)
    _note_gold(lake, last)


def _note_gold(lake: Lake, refresh_id: int) -> None:
    io.write_table(lake.spark.createDataFrame([(refresh_id,)], "refresh_id long"), lake.path("gold_state"), "append", lake.fmt)


def refresh_gold(lake: Lake) -> None:
    """Rebuild gold from the whole of silver; notes the silver refresh it
    has seen, so an incremental run can follow."""
    st = _silver_state(lake)
    lake.write_layer(gold.build_features(lake.layer("silver_sales")), "gold_sales_features", check="gold")
    if st:
        _note_gold(lake, st["refresh_id"])


def train(lake: Lake, role: str, env: str = "DEV", forest: dict | None = None) -> str:
    """Fit on the holdout's train side, evaluate on its test side, record."""
    train_df, test_df = slices.split_holdout(lake.dated("gold_sales_features"))
    matrix = models.feature_matrix(train_df, keep=config.KEYS).persist()
    try:
        if role == config.BASELINE:
            model = models.fit_baseline(matrix)
            params = {"model_type": models.LINEAR, "holdout_days": str(config.HOLDOUT_DAYS)}
        else:
            fp = {"num_trees": 100, "max_depth": 10, "seed": 42, **(forest or {})}
            model = models.fit_challenger(matrix, row_key=config.KEYS, **fp)
            params = {"model_type": models.FOREST, "n_estimators": str(fp["num_trees"]), "max_depth": str(fp["max_depth"])}
    finally:
        matrix.unpersist()
    m = models.error_metrics(models.score(model, models.feature_matrix(test_df))).first()
    if not m["n_rows"]:
        raise RuntimeError(f"the holdout of the {role} run has no complete row; no metrics to record")
    return registry.record_run(lake.spark, lake.path("model_runs"), model, role, env, m["mae"], m["rmse"], params=params)


def forecast(lake: Lake, env: str = "DEV", selector: str = "latest", ts: Column | None = None,
             role_label: str | None = None) -> None:
    """Score the latest observed day with the newest run (``selector=
    'latest'``) or the active pointer's run (``'active'``); append."""
    runs = registry.runs_for_env(lake.read("model_runs"), env)
    if selector == "active":
        ptr = registry.active_decision(lake.read("model_decisions"))
        run = runs.join(F.broadcast(ptr.select(F.col("model_run_id").alias("run_id"))), "run_id")
    else:
        run = registry.latest_run(runs)
    info = run.select("run_id", "model_role", "model_type", "model_path").first()
    if info is None:
        raise RuntimeError("no model run to forecast with")
    model = models.load_model(info["model_type"], info["model_path"])
    latest = slices.latest_slice(lake.dated("gold_sales_features"))
    scored = models.score(model, models.feature_matrix(latest, keep=("date", "store", "item"), label=None))
    out = scored.select(
        "date", "store", "item", *config.FEATURES, "predicted_sales",
        F.lit(info["run_id"]).alias("model_run_id"),
        F.lit(role_label or info["model_role"]).alias("model_role"),
        (ts if ts is not None else F.current_timestamp()).alias("prediction_timestamp"),
    )
    io.write_table(out, lake.path("gold_sales_forecast"), "append", lake.fmt)


def training_flow(spark: SparkSession, root: str, raw_path: str, env: str = "DEV", as_of: Column | None = None,
                  forest: dict | None = None, incremental_as_of=None) -> dict:
    """Raw CSV -> bronze -> silver -> gold -> baseline + challenger -> forecast.

    ``incremental_as_of`` (a date) switches layer maintenance to
    ``refresh_silver_incremental`` + ``refresh_gold_incremental``: only new
    loads are deduplicated, and only the changed tail of each changed series
    is re-featured, instead of the whole history."""
    lake = Lake(spark, root)
    ingest_raw(lake, raw_path)
    if incremental_as_of is not None:
        refresh_silver_incremental(lake, incremental_as_of)
        refresh_gold_incremental(lake)
    else:
        refresh_silver(lake, as_of)
        refresh_gold(lake)
    base = train(lake, config.BASELINE, env)
    chal = train(lake, config.CHALLENGER, env, forest)
    forecast(lake, env)
    return {"baseline_run_id": base, "challenger_run_id": chal}


# ---------------------------------------------------- selection / monitor

def _load(lake: Lake, run_id_col: Column) -> models.Model:
    runs = lake.read("model_runs")
    return registry.load_run_model(runs.filter(F.col("run_id") == run_id_col))


def _evaluation(lake: Lake) -> DataFrame:
    """Complete rows of the last 30 days."""
    recent = slices.since(lake.dated("gold_sales_features"), config.EVAL_DAYS)
    return slices.complete_rows(recent, [*config.KEYS, config.TARGET, *config.FEATURES])


def select_champion(lake: Lake, env: str = "DEV", ts: Column | None = None) -> DataFrame:
    """Score both latest role runs on the last 30 days; append the pointer."""
    per_role = registry.latest_per_role(registry.runs_for_env(lake.read("model_runs"), env))
    piv = registry.role_pivot(per_role, "mae").first()
    b_model = _load(lake, F.lit(piv["baseline_run_id"]))
    c_model = _load(lake, F.lit(piv["challenger_run_id"]))
    scored = models.score_side_by_side(_evaluation(lake), {"pred_b": b_model, "pred_c": c_model})
    maes = models.mae_by(scored, {"baseline_mae": "pred_b", "challenger_mae": "pred_c"}, count="n_rows")
    maes = slices.required(maes, "n_rows", "model selection")
    rows = registry.decision_rows(registry.champion(maes, per_role), ts)
    return registry.append_decisions(lake.spark, rows, lake.path("model_decisions"))


def monitor_performance(lake: Lake, env: str = "DEV", ts: Column | None = None,
                        factor: float = config.ALERT_ROLLBACK_FACTOR) -> DataFrame:
    """Active model against the baseline on the last 30 days; ``factor`` is
    the degradation that counts.  An empty window fails inside the plan."""
    ptr = registry.active_decision(lake.read("model_decisions")).first()
    per_role = registry.latest_per_role(registry.runs_for_env(lake.read("model_runs"), env))
    base_id = registry.role_pivot(per_role, "mae").first()["baseline_run_id"]
    scored = models.score_side_by_side(
        _evaluation(lake), {"pred_b": _load(lake, F.lit(base_id)), "pred_a": _load(lake, F.lit(ptr["model_run_id"]))}
    )
    maes = models.mae_by(scored, {"baseline_mae": "pred_b", "active_model_mae": "pred_a"}, count="n_rows")
    maes = slices.required(maes, "n_rows", "performance monitoring")
    row = monitoring.performance_frame(maes, F.lit(ptr["active_model"]), ts if ts is not None else F.current_timestamp(), factor)
    io.write_table(schemas.conform(row, schemas.PERFORMANCE), lake.path("model_performance_metrics"), "append", lake.fmt)
    return lake.read("model_performance_metrics")


def monitor_drift(lake: Lake, ts: Column | None = None) -> DataFrame:
    d = monitoring.drift_metrics(lake.dated("gold_sales_features"), ts)
    io.write_table(schemas.conform(d, schemas.DRIFT), lake.path("feature_drift_metrics"), "append", lake.fmt)
    return lake.read("feature_drift_metrics")


def alert_and_rollback(lake: Lake, env: str = "DEV", ts: Column | None = None,
                       threshold: float = config.ALERT_DRIFT_THRESHOLD,
                       factor: float = config.ALERT_ROLLBACK_FACTOR) -> dict:
    """Publish drift alerts for the latest batch; roll the pointer back to
    the baseline run when drift on a critical feature is severe and the
    challenger's logged MAE is worse than the baseline's by the factor."""
    latest = slices.latest_slice(lake.read("feature_drift_metrics"), "evaluation_timestamp")
    published = alerts.publish_alerts(lake.spark, alerts.drift_alerts(latest, ts, threshold), lake.path("ml_alerts"))
    per_role = registry.latest_per_role(registry.runs_for_env(lake.read("model_runs"), env))
    piv = registry.role_pivot(per_role, "mae")
    sev = alerts.severe_drift(latest, by=(), threshold=threshold)
    decision = sev.select(
        F.lit(config.BASELINE).alias("active_model"),
        piv.select("baseline_run_id").scalar().alias("model_run_id"),
        alerts.rollback_rule(F.col("severe_drift"), piv.select("baseline_mae").scalar(),
                             piv.select("challenger_mae").scalar(), factor).alias("rollback_required"),
    )
    rows = registry.decision_rows(decision.filter("rollback_required"), ts, F.lit("AUTO_ROLLBACK"))
    log = registry.append_decisions(lake.spark, rows, lake.path("model_decisions"))
    return {"alerts": published, "pointer": registry.active_decision(log)}


def monitoring_flow(spark: SparkSession, root: str, env: str = "DEV", threshold: float = config.ALERT_DRIFT_THRESHOLD,
                    factor: float = config.ALERT_ROLLBACK_FACTOR) -> dict:
    """``threshold`` of drift and ``factor`` of degradation are the caller's."""
    lake = Lake(spark, root)
    perf = monitor_performance(lake, env, factor=factor)
    drift = monitor_drift(lake)
    out = alert_and_rollback(lake, env, threshold=threshold, factor=factor)
    return {"performance": perf, "drift": drift, **out}
