"""Bronze: raw strings -> typed, shifted, stamped rows with promo columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake import config
from demandlake.functions import columns as C


def type_sales(df: DataFrame, date_col: str = "date", sales_col: str = "sales") -> DataFrame:
    """Lenient typing: ``date`` -> DATE, ``sales`` -> INT, malformed -> NULL.

    Other columns (``store``, ``item`` and any extra raw column) keep their
    type and position."""
    return df.withColumns({date_col: C.lenient_date(date_col), sales_col: C.lenient_int(sales_col)})


def shift_dates(df: DataFrame, days: int = config.DATE_SHIFT_DAYS, date_col: str = "date") -> DataFrame:
    return df.withColumn(date_col, F.date_add(F.col(date_col), days))


def stamp(df: DataFrame, ts: Column | None = None, name: str = "ingestion_timestamp") -> DataFrame:
    """Add a load-time column; one value per query (``current_timestamp`` is
    folded once by the optimizer) or a pinned value."""
    return df.withColumn(name, ts if ts is not None else F.current_timestamp())


def promo_bucket(df: DataFrame, keys: Sequence[str] = ("store", "item", "date"), name: str = "bucket") -> DataFrame:
    return df.withColumn(name, C.hash_bucket(keys))


def assign_promo(df: DataFrame, keys: Sequence[str] = ("store", "item", "date")) -> DataFrame:
    """Deterministic promo flag and discount from a hash bucket of the keys,
    in one projection."""
    bucket = C.hash_bucket(keys)
    flag = C.promo_flag(bucket)
    return df.withColumns({"is_promo": flag, "discount_pct": C.promo_discount(bucket, flag)})


def evolve_union(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Bag union by column name; columns missing on one side become NULL
    (the in-plan form of an append with schema evolution)."""
    return older.unionByName(newer, allowMissingColumns=True)


def ingest(
    raw: DataFrame,
    ts: Column | None = None,
    shift_days: int = config.DATE_SHIFT_DAYS,
    with_promo: bool = True,
) -> DataFrame:
    """Raw strings -> bronze rows in one projection chain (no shuffle)."""
    df = stamp(shift_dates(type_sales(raw), shift_days), ts)
    return assign_promo(df) if with_promo else df
