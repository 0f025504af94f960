"""Silver: cleaned rows, one per (date, store, item), newest load wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlake import config
from demandlake.functions import columns as C


def clean(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Field cleaning in the application's order.

    1. ``date`` must exist and be at most one day after ``as_of``
       (default: today).
    2. ``sales`` NULL or negative -> 0; ``is_promo`` NULL -> 0;
       ``discount_pct`` NULL -> 0.0.
    3. ``store`` and ``item`` must exist.

    The filters run before deduplication, so an invalid row never competes
    for its key (a newer invalid row cannot hide an older valid one).
    """
    as_of = as_of if as_of is not None else F.current_date()
    df = df.filter(F.col("date").isNotNull()).filter(
        F.col("date") <= F.date_add(as_of, config.FUTURE_TOLERANCE_DAYS)
    )
    fixes = {"sales": C.clamp_non_negative("sales")}
    if "is_promo" in df.columns:
        fixes["is_promo"] = C.default_if_null("is_promo", 0)
    if "discount_pct" in df.columns:
        fixes["discount_pct"] = C.default_if_null("discount_pct", 0.0)
    return df.withColumns(fixes).filter(F.col("store").isNotNull() & F.col("item").isNotNull())


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str] = config.KEYS,
    order: Sequence[Column] | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Keep the first row per key under ``order`` (newest version wins).

    ``row_number() == 1`` lets Spark insert a partial window-group limit
    before the shuffle, so each map task ships at most one row per key: a
    key holding a third of all rows costs one row per task, not a third of
    the data in one task.  Pass tie-breaking columns in ``order`` to make
    the winner deterministic when timestamps are equal.
    """
    if order is None:
        order = [F.col("ingestion_timestamp").desc()]
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    return out.drop(*drop) if drop else out


def build_silver(bronze: DataFrame, as_of: Column | None = None, tie_breakers: Sequence[Column] = ()) -> DataFrame:
    order = [F.col("ingestion_timestamp").desc(), *tie_breakers]
    return latest_per_key(clean(bronze, as_of), config.KEYS, order)
