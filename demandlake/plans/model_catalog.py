"""Registered queries of fitted models: OLS and the forest are fitted on the
holdout's train side and scored on its test side, on the last 30 days and on
the latest day.  Their SQL (``model_oracle``) fits both again.

``forest_nodes`` fits the challenger whole (``CHALLENGER``), as training and
``forest_invariants`` do; ``FOREST`` keeps the SQL of the queries that score a
forest small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake import config
from demandlake.operators import models, registry, slices
from demandlake.operators.forest import Forest
from demandlake.plans import catalog
from demandlake.plans import params as P
from demandlake.sources import io, storage

CHALLENGER = {"num_trees": 100, "max_depth": 10, "seed": 42}
FOREST = {"num_trees": 6, "max_depth": 3, "seed": 42}


def _sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Train and test matrices, with the row keys."""
    train, test = slices.split_holdout(catalog._gold_table(spark, sf))
    return models.feature_matrix(train, keep=config.KEYS), models.feature_matrix(test, keep=config.KEYS)


def _forest(train: DataFrame, settings: dict = FOREST) -> Forest:
    return models.fit_challenger(train, row_key=config.KEYS, **settings)


def _metrics(role: str, scored: DataFrame) -> DataFrame:
    m = models.error_metrics(scored)
    return m.select(F.lit(role).alias("model_role"), "n_rows", F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse"))


def gram_matrix(spark, sf):
    """Mean products of all pairs of terms over the training rows."""
    train, _ = _sides(spark, sf)
    g = models.gram_rows(train)
    return g.select("term_i", "term_j", "n_rows", F.round(F.col("total") / F.col("n_rows"), 6).alias("mean_product"))


def ols_coefficients(spark, sf):
    train, _ = _sides(spark, sf)
    c = models.coefficients(spark, models.fit_baseline(train))
    return c.select("term", F.round("coefficient", 6).alias("coefficient"))


def holdout_metrics(spark, sf):
    train, test = _sides(spark, sf)
    return _metrics(config.BASELINE, models.score(models.fit_baseline(train), test))


def forest_nodes(spark, sf):
    """The fitted challenger, every tree to its full depth, as its node table."""
    train, _ = _sides(spark, sf)
    return _forest(train, CHALLENGER).nodes(spark)


def forest_holdout_metrics(spark, sf):
    train, test = _sides(spark, sf)
    return _metrics(config.CHALLENGER, models.score(_forest(train), test))


def stump_means(spark, sf):
    """A tree of depth 1 on ``is_promo`` over every row once: its leaves are
    the mean sales with and without promotion."""
    train, _ = _sides(spark, sf)
    settings = models.forest.Settings(num_trees=1, max_depth=1, bootstrap=False)
    stump = models.forest.grow(train, ["is_promo"], config.TARGET, config.KEYS, settings)
    leaves = stump.nodes(spark).where("node > 1")
    return leaves.select((F.col("node") - 2).cast("int").alias("is_promo"), F.col("weight").cast("long").alias("n_rows"), F.round("value", 6).alias("mean_sales"))


def fitted_model_comparison(spark, sf):
    """Both fitted models on the same rows of the last 30 days, one pass."""
    train, _ = _sides(spark, sf)
    recent = slices.since(catalog._gold_table(spark, sf), config.EVAL_DAYS)
    rows = slices.complete_rows(recent, [*config.KEYS, config.TARGET, *config.FEATURES])
    both = models.score_side_by_side(rows, {"pred_b": models.fit_baseline(train), "pred_c": _forest(train)})
    maes = models.mae_by(both, {"baseline_mae": "pred_b", "challenger_mae": "pred_c"})
    return maes.select(F.round("baseline_mae", 6).alias("baseline_mae"), F.round("challenger_mae", 6).alias("challenger_mae"))


def _recorded(spark, sf, runs_path: str) -> dict[str, str]:
    """Fit both roles, record both runs; run ids by role."""
    train, test = _sides(spark, sf)
    ids = {}
    for role, model in ((config.BASELINE, models.fit_baseline(train)), (config.CHALLENGER, _forest(train))):
        m = models.error_metrics(models.score(model, test)).first()
        ids[role] = registry.record_run(spark, runs_path, model, role, P.ENV, m["mae"], m["rmse"], params={"holdout_days": str(config.HOLDOUT_DAYS)})
    return ids


def forest_forecast(spark, sf):
    """Save, load and score a fitted forest: both roles are recorded, the
    newest run's model is loaded by its row, the latest day is scored and
    appended to the forecast table, which is read back."""
    runs_path = storage.scratch_path(spark, "model_runs")
    ids = _recorded(spark, sf, runs_path)
    runs = registry.runs_for_env(io.read_back(spark, runs_path), P.ENV)
    run = registry.latest_run(runs)
    info = run.first()
    latest = slices.latest_slice(catalog._gold_table(spark, sf))
    scored = models.score(registry.load_run_model(run), models.feature_matrix(latest, keep=config.KEYS, label=None))
    path = storage.scratch_path(spark, "gold_sales_forecast")
    out = scored.select(
        *config.KEYS, *config.FEATURES, "predicted_sales", F.lit(info["run_id"]).alias("model_run_id"), F.lit(info["model_role"]).alias("model_role"),
        P.ts(P.EVAL_TS).alias("prediction_timestamp"),
    )
    io.write_table(out, path, "append")
    back = io.read_back(spark, path)
    return back.select(
        *config.KEYS, F.round("predicted_sales", 6).alias("predicted_sales"), "model_role",
        (F.col("model_run_id") == ids[config.CHALLENGER]).alias("run_is_newest"), "prediction_timestamp",
    )


def run_metrics(spark, sf):
    """The run rows of both fitted roles as recorded: type and holdout errors."""
    runs_path = storage.scratch_path(spark, "model_runs")
    _recorded(spark, sf, runs_path)
    per_role = registry.latest_per_role(registry.runs_for_env(io.read_back(spark, runs_path), P.ENV))
    return per_role.select("model_role", "model_type", "env", "features", F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse"))


MODEL_QUERIES = {f.__name__: f for f in (
    gram_matrix, ols_coefficients, holdout_metrics, forest_nodes, forest_holdout_metrics, stump_means, fitted_model_comparison, forest_forecast, run_metrics,
)}
