"""Run registry and the active-model pointer, as tables.

* ``model_runs``: one row per training run (params, metrics, tags, model
  path); linear models are saved with MLlib's writer, forests as their node
  table, into the shared folder.
* ``model_decisions``: an append-only log of pointer changes; the active
  model is the latest row (a view), so nothing is ever overwritten while
  it is being read.

Latest-per-role uses an aggregate (``max_by`` over a struct), so each map
task ships one row per role: with two roles, a role holding half the runs
still never lands whole in one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake import config
from demandlake.operators import models
from demandlake.operators.forest import Forest
from demandlake.sources import io, schemas, storage
from demandlake.sources.versioned import VersionedTable


def record_run(
    spark: SparkSession,
    runs_path: str,
    model: Model | Forest,
    role: str,
    env: str,
    mae: float,
    rmse: float,
    params: Mapping[str, str] | None = None,
    features: Sequence[str] = config.FEATURES,
    model_root: str | None = None,
    start_time: datetime | None = None,
) -> str:
    """Save the model and append its run row; returns the run id."""
    run_id = uuid.uuid4().hex
    root = model_root or storage.shared_root(spark) + "/demandlake/models"
    path = f"{root}/{run_id}"
    models.save_model(spark, model, path)
    row = (
        run_id,
        start_time or datetime.now(timezone.utc).replace(tzinfo=None),
        env,
        role,
        models.model_type(model),
        dict(params or {}),
        ",".join(features),
        float(mae),
        float(rmse),
        path,
    )
    io.append_if_any(io.control_rows(spark, [row], schemas.MODEL_RUNS), runs_path)
    return run_id


def load_run_model(run: DataFrame) -> Model | Forest:
    """Load the model of a one-row run frame (``model_type``, ``model_path``)."""
    r = run.select("model_type", "model_path").first()
    if r is None:
        raise RuntimeError("no such run")
    return models.load_model(r["model_type"], r["model_path"])


def runs_for_env(runs: DataFrame, env: str) -> DataFrame:
    return runs.filter(F.col("env") == env)


def latest_run(runs: DataFrame) -> DataFrame:
    """Newest run of any role (ties: larger run id); top-1, no full sort."""
    return runs.orderBy(F.col("start_time").desc(), F.col("run_id").desc()).limit(1)


def latest_per_role(runs: DataFrame, role_col: str = "model_role") -> DataFrame:
    """Newest run per role (ties: larger run id), via a partial+final aggregate."""
    others = [c for c in runs.columns if c != role_col]
    best = F.max_by(F.struct(*others), F.struct("start_time", "run_id"))
    return runs.groupBy(role_col).agg(best.alias("r")).select(role_col, *[F.col(f"r.{c}").alias(c) for c in others])


def role_pivot(per_role: DataFrame, value: str = "mae") -> DataFrame:
    """One row: baseline/challenger run id and value side by side."""
    b = F.col("model_role") == config.BASELINE
    c = F.col("model_role") == config.CHALLENGER
    return per_role.agg(
        F.max(F.when(b, F.col("run_id"))).alias("baseline_run_id"),
        F.max(F.when(b, F.col(value))).alias(f"baseline_{value}"),
        F.max(F.when(c, F.col("run_id"))).alias("challenger_run_id"),
        F.max(F.when(c, F.col(value))).alias(f"challenger_{value}"),
    )


def active_decision(decisions: DataFrame) -> DataFrame:
    """The latest pointer row (ties: larger run id)."""
    return decisions.orderBy(F.col("decision_timestamp").desc(), F.col("model_run_id").desc()).limit(1)


def active_run(decisions: DataFrame, runs: DataFrame) -> DataFrame:
    """Pointer -> run lookup without moving the run table.

    The run table is filtered by the pointer's run id (a scalar subquery
    that reaches the scan as a data filter), so only matching runs leave
    the scan; the final left join is between that match and the one-row
    pointer, both bounded."""
    ptr = active_decision(decisions)
    match = runs.filter(F.col("run_id") == ptr.select("model_run_id").scalar())
    return ptr.join(match, ptr.model_run_id == match.run_id, "left").drop("run_id")


def champion(maes: DataFrame, per_role: DataFrame, margin: float = config.CHAMPION_MARGIN) -> DataFrame:
    """Champion rule on a one-row frame with ``baseline_mae`` and
    ``challenger_mae``: the challenger wins only if strictly better than
    baseline * (1 - margin).  Picks the run id of the winning role.

    The MAEs are unpivoted to (model_role, mae) and equi-joined to the
    per-role runs (two rows each side), then folded back to one row."""
    long = maes.selectExpr(
        f"stack(2, '{config.BASELINE}', baseline_mae, '{config.CHALLENGER}', challenger_mae) AS (model_role, eval_mae)"
    )
    both = long.join(per_role.select("model_role", "run_id"), "model_role", "left")
    b = F.col("model_role") == config.BASELINE
    c = F.col("model_role") == config.CHALLENGER
    one = both.agg(
        F.max(F.when(b, F.col("eval_mae"))).alias("baseline_mae"),
        F.max(F.when(c, F.col("eval_mae"))).alias("challenger_mae"),
        F.max(F.when(b, F.col("run_id"))).alias("baseline_run_id"),
        F.max(F.when(c, F.col("run_id"))).alias("challenger_run_id"),
    )
    wins = F.col("challenger_mae") < F.col("baseline_mae") * F.lit(1 - margin)
    return one.select(
        F.when(wins, config.CHALLENGER).otherwise(config.BASELINE).alias("active_model"),
        F.when(wins, F.col("challenger_run_id")).otherwise(F.col("baseline_run_id")).alias("model_run_id"),
        "baseline_mae",
        "challenger_mae",
    )


def decision_rows(decision: DataFrame, ts: Column | None = None, reason: Column | None = None) -> DataFrame:
    """Shape decision rows for the pointer log."""
    return schemas.conform(
        decision.select(
            "active_model",
            "model_run_id",
            (reason if reason is not None else F.lit(None).cast("string")).alias("reason"),
            (ts if ts is not None else F.current_timestamp()).alias("decision_timestamp"),
        ),
        schemas.MODEL_DECISIONS,
    )


def append_decisions(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    io.append_if_any(schemas.conform(rows, schemas.MODEL_DECISIONS), path)
    return io.read_back(spark, path)


def restamp(pointer: DataFrame, ts: Column | None = None) -> DataFrame:
    """The pointer with its decision time replaced by now (or ``ts``)."""
    return pointer.withColumn("decision_timestamp", ts if ts is not None else F.current_timestamp())


def restamp_table(table: VersionedTable, ts: Column | None = None) -> DataFrame:
    """Overwrite the pointer table from itself, re-stamped; read back."""
    return table.replace(schemas.conform(restamp(table.read(), ts), table.schema))


def ordered_history(df: DataFrame, ts_col: str) -> DataFrame:
    """Newest first; the run id orders the rows of one stamp, so they spread
    over the sort's ranges."""
    return df.orderBy(F.col(ts_col).desc(), F.col("model_run_id"))
