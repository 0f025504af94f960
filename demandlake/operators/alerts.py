"""Drift alerts, severe-drift flag and the rollback rule.

Thresholds are arguments; the defaults are the alert step's own constants
(0.25 and 1.05), which it applies whatever the environment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake import config
from demandlake.sources import schemas
from demandlake.sources.versioned import VersionedTable


def above(threshold: float) -> Column:
    """psi over the threshold.  Spark orders NaN above every number, so an
    undefined psi is excluded by name."""
    return (F.col("psi") > threshold) & ~F.isnan("psi")


def drift_alerts(
    drift: DataFrame,
    ts: Column | None = None,
    threshold: float = config.ALERT_DRIFT_THRESHOLD,
    critical: Sequence[str] = config.CRITICAL_FEATURES,
) -> DataFrame:
    """One DRIFT alert per feature with psi > threshold (strict): HIGH for a
    business-critical feature, else MEDIUM.  NULL and NaN psi never alert."""
    return drift.filter(above(threshold)).select(
        F.col("feature"),
        F.col("psi").cast("double").alias("metric_value"),
        F.when(F.col("feature").isin(*critical), "HIGH").otherwise("MEDIUM").alias("severity"),
        F.lit("DRIFT").alias("alert_type"),
        (ts if ts is not None else F.current_timestamp()).alias("alert_timestamp"),
    )


def severe_flag(
    threshold: float = config.ALERT_DRIFT_THRESHOLD,
    critical: Sequence[str] = config.CRITICAL_FEATURES,
) -> Column:
    """Aggregate: any critical feature above the threshold (false when empty)."""
    return F.coalesce(
        F.bool_or(above(threshold) & F.col("feature").isin(*critical)), F.lit(False)
    )


def severe_drift(
    drift: DataFrame,
    by: Sequence[str] = ("evaluation_timestamp",),
    threshold: float = config.ALERT_DRIFT_THRESHOLD,
    critical: Sequence[str] = config.CRITICAL_FEATURES,
) -> DataFrame:
    """Severe-drift flag per batch (partial+final aggregate, one row out per
    batch); ``by=()`` gives one flag for the whole frame."""
    flag = severe_flag(threshold, critical).alias("severe_drift")
    return drift.groupBy(*by).agg(flag) if by else drift.agg(flag)


def rollback_rule(severe: Column, baseline_mae: Column, challenger_mae: Column,
                  factor: float = config.ALERT_ROLLBACK_FACTOR) -> Column:
    """Roll back only if drift is severe AND the challenger's logged MAE is
    worse than the baseline's by more than the factor."""
    return F.coalesce(severe & (challenger_mae > baseline_mae * F.lit(factor)), F.lit(False))


def publish_alerts(spark: SparkSession, alerts: DataFrame, path: str, keep_history: bool = False) -> DataFrame:
    """Reset the alert table to its declared schema (unless history is
    kept), append this batch's alerts (an empty batch adds nothing) and
    return the table as read back.  Both take effect in one step: no reader
    sees the emptied table before this batch is in it."""
    table = VersionedTable(spark, path, schemas.ALERTS)
    before = table.read() if keep_history else schemas.empty_frame(spark, schemas.ALERTS)
    return table.replace(before.unionByName(schemas.conform(alerts, schemas.ALERTS)))
