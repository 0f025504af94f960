"""Feature drift (PSI) and performance degradation.

PSI per feature, with equal-width bins from the reference sample:

* edges from the reference: lo = min, hi = max, width = (hi - lo) / bins,
  edge_i = lo + i * width; a constant feature uses lo - 0.5 .. hi + 0.5;
* a value x in [lo, hi] falls in bin #{i in 1..bins-1 : x >= edge_i}
  (the last bin is closed at hi); values outside [lo, hi] are not binned
  but still count in their side's total;
* share = bin count / side total;
  psi = sum over bins of (ref - cur) * ln((ref + eps) / (cur + eps)).

Plan: both samples are unpivoted once into (side, feature, value), joined
to the per-feature edge table (one row per feature: a broadcast whose size
is the number of features, not the data), binned with plain comparisons
and counted with a partial+final aggregate.  The only shuffle carries at
most (#features x (bins + 1) x 2) rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlake import config
from demandlake.operators import slices


def drift_windows(
    gold: DataFrame,
    features: Sequence[str] = config.DRIFT_FEATURES,
    reference_days: int = config.DRIFT_REFERENCE_DAYS,
    current_days: int = config.DRIFT_CURRENT_DAYS,
) -> tuple[DataFrame, DataFrame]:
    """Reference = before max-90d, current = on/after max-30d; rows must be
    complete in every drift feature.  The days in between belong to neither."""
    ref = slices.complete_rows(slices.before(gold, reference_days), features)
    cur = slices.complete_rows(slices.since(gold, current_days), features)
    return ref, cur


def bin_edges(reference: DataFrame, features: Sequence[str], bins: int = config.PSI_BINS) -> DataFrame:
    """(feature, lo, hi, width): one wide aggregate pass, then unpivot."""
    aggs = []
    for i, f in enumerate(features):
        x = F.col(f).cast("double")
        aggs += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    wide = reference.agg(*aggs)
    rows = F.explode(
        F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"lo{i}").alias("lo"), F.col(f"hi{i}").alias("hi"))
                  for i, f in enumerate(features)])
    )
    e = wide.select(rows.alias("e")).select("e.*")
    const = F.col("lo") == F.col("hi")
    e = e.select(
        "feature",
        F.when(const, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(const, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    return e.withColumn("width", (F.col("hi") - F.col("lo")) / F.lit(float(bins)))


def bin_index(value: Column, lo: Column, hi: Column, width: Column, bins: int = config.PSI_BINS) -> Column:
    """Bin number 0..bins-1, NULL when outside [lo, hi]."""
    idx = F.lit(0)
    for i in range(1, bins):
        idx = idx + F.when(value >= lo + F.lit(i) * width, 1).otherwise(0)
    return F.when((value >= lo) & (value <= hi), idx)


def drift_sides(
    gold: DataFrame | slices.Dated,
    features: Sequence[str] = config.DRIFT_FEATURES,
    reference_days: int = config.DRIFT_REFERENCE_DAYS,
    current_days: int = config.DRIFT_CURRENT_DAYS,
) -> DataFrame:
    """Both windows from ONE scan: (side, features...), side 'ref' or 'cur'."""
    mx = slices.max_of(gold)  # one scalar subquery serves both cutoffs
    ref_cut = F.date_sub(mx, reference_days)
    cur_cut = F.date_sub(mx, current_days)
    day = F.col("date")
    either = slices.window(
        gold, (day < ref_cut) | (day >= cur_cut),
        lambda month: (month <= slices.month_of(ref_cut)) | (month >= slices.month_of(cur_cut)),
    )
    side = F.when(day < ref_cut, "ref").otherwise("cur")
    return either.select(side.alias("side"), *features).dropna(how="any", subset=list(features))


def histogram(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str] = config.DRIFT_FEATURES,
    bins: int = config.PSI_BINS,
) -> DataFrame:
    """(feature, bin, n_ref, n_cur, ref_share, cur_share), every bin present."""
    sides = reference.select(F.lit("ref").alias("side"), *features).unionByName(
        current.select(F.lit("cur").alias("side"), *features)
    )
    return histogram_sides(sides, features, bins)


def histogram_sides(
    sides: DataFrame,
    features: Sequence[str] = config.DRIFT_FEATURES,
    bins: int = config.PSI_BINS,
) -> DataFrame:
    """Histogram from a side-tagged sample (see ``drift_sides``).

    Two passes over the sample: the reference min/max (edges), then one
    binning aggregate.  Empty cells come from a constant (feature, bin)
    grid unioned into that aggregate, and side totals (which include values
    outside [lo, hi], the NULL bin) are a window over its tiny output."""
    edges = bin_edges(sides.filter(F.col("side") == "ref"), features, bins)
    pairs = ", ".join(f"'{f}', CAST(`{f}` AS DOUBLE)" for f in features)
    both = sides.selectExpr("side", f"stack({len(features)}, {pairs}) AS (feature, value)")
    binned = both.join(F.broadcast(edges), "feature").select(
        "feature",
        bin_index(F.col("value"), F.col("lo"), F.col("hi"), F.col("width"), bins).alias("bin"),
        (F.col("side") == "ref").cast("long").alias("is_ref"),
        (F.col("side") == "cur").cast("long").alias("is_cur"),
    )
    grid = sides.sparkSession.createDataFrame(
        [(f, b, 0, 0) for f in features for b in range(bins)], "feature string, bin int, is_ref long, is_cur long"
    )
    counts = binned.unionByName(grid).groupBy("feature", "bin").agg(
        F.sum("is_ref").alias("n_ref"), F.sum("is_cur").alias("n_cur")
    )
    per_feature = Window.partitionBy("feature")
    h = counts.withColumns({
        "ref_total": F.sum("n_ref").over(per_feature),
        "cur_total": F.sum("n_cur").over(per_feature),
    }).filter(F.col("bin").isNotNull())
    return h.select(
        "feature", "bin", "n_ref", "n_cur",
        F.try_divide(F.col("n_ref").cast("double"), F.col("ref_total")).alias("ref_share"),
        F.try_divide(F.col("n_cur").cast("double"), F.col("cur_total")).alias("cur_share"),
    )


def psi_from_histogram(hist: DataFrame, eps: float = config.PSI_EPSILON) -> DataFrame:
    """(feature, psi); an empty side gives NULL (never an alert)."""
    e, a = F.col("ref_share"), F.col("cur_share")
    term = (e - a) * F.ln((e + F.lit(eps)) / (a + F.lit(eps)))
    return hist.groupBy("feature").agg(
        F.when(F.count_if(e.isNull() | a.isNull()) > 0, F.lit(None).cast("double")).otherwise(F.sum(term)).alias("psi")
    )


def feature_psi(
    gold: DataFrame,
    features: Sequence[str] = config.DRIFT_FEATURES,
    bins: int = config.PSI_BINS,
) -> DataFrame:
    return psi_from_histogram(histogram_sides(drift_sides(gold, features), features, bins))


def drift_metrics(gold: DataFrame, ts: Column | None = None, features: Sequence[str] = config.DRIFT_FEATURES) -> DataFrame:
    """(feature, psi, evaluation_timestamp): one timestamp for the batch."""
    return feature_psi(gold, features).withColumn(
        "evaluation_timestamp", ts if ts is not None else F.current_timestamp()
    )


def degradation(baseline_mae: Column, active_mae: Column) -> Column:
    """(active - baseline) / baseline; NULL when the baseline is 0 (ANSI-safe)."""
    return F.try_divide(active_mae - baseline_mae, baseline_mae)


def degradation_status(baseline_mae: Column, active_mae: Column, rollback: float = 1.05) -> Column:
    """DEGRADED when degradation > rollback - 1 (strict).  A zero baseline is
    DEGRADED when the active model has any error, else OK."""
    d = degradation(baseline_mae, active_mae)
    threshold = F.lit(rollback - 1)
    return (
        F.when(d.isNull() & (baseline_mae == 0) & (active_mae > 0), "DEGRADED")
        .when(d > threshold, "DEGRADED")
        .otherwise("OK")
    )


def performance_frame(maes: DataFrame, active_model: Column, ts: Column, rollback: float = 1.05) -> DataFrame:
    """One performance row from a frame with ``baseline_mae`` and
    ``active_model_mae`` columns."""
    b, a = F.col("baseline_mae"), F.col("active_model_mae")
    d = degradation(b, a)
    return maes.select(
        active_model.alias("active_model"),
        b.alias("baseline_mae"),
        a.alias("active_model_mae"),
        F.when(d.isNull() & (b == 0) & (a > 0), F.lit(float("inf")))
        .otherwise(F.coalesce(d, F.lit(0.0)))
        .alias("degradation_pct"),
        degradation_status(b, a, rollback).alias("status"),
        ts.alias("evaluation_timestamp"),
    )
