"""Inline table checks: one aggregate, or metrics observed while a layer is
written (no pass of their own), as long-form (layer, check, value) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from demandlake.sources import schemas


def date_bounds(df: DataFrame, c: str = "date") -> DataFrame:
    return df.agg(F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))


def promo_summary(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.sum("is_promo").alias("promo_rows"))


def sales_totals(df: DataFrame) -> DataFrame:
    return df.agg(F.sum("is_promo").alias("promo_rows"), F.sum("sales").alias("total_sales"))


def null_count(df: DataFrame, c: str, name: str) -> DataFrame:
    """Rows less values: two counts that file statistics can answer."""
    return df.agg((F.count(F.lit(1)) - F.count(c)).alias(name))


def _metrics(layer: str) -> list:
    rows, promo = F.count(F.lit(1)).alias("row_count"), F.sum("is_promo").alias("promo_rows")
    lo, hi = F.min("date").alias("min_date"), F.max("date").alias("max_date")
    return {
        "bronze": [rows, lo, hi, promo],
        "silver": [rows, promo, F.sum("sales").alias("total_sales")],
        "gold": [rows, F.count_if(F.col("sales_lag_7").isNull()).alias("rows_with_null_lag"), lo, hi],
    }[layer]


def observed(df: DataFrame, layer: str) -> tuple[DataFrame, Observation]:
    """``df`` with the layer's checks taken while it is written.

    Put it last before the write: there, each row counts once, even if a
    task has to run again."""
    taken = Observation()
    return df.observe(taken, *_metrics(layer)), taken


def check_rows(spark: SparkSession, layer: str, values: dict) -> DataFrame:
    """The checks of one write as (layer, check, value) rows."""
    rows = [(layer, name, None if v is None else str(v)) for name, v in values.items()]
    return spark.createDataFrame(rows, schemas.LAYER_CHECKS)
