"""Gold: calendar fields, lags and trailing means per (store, item) series.

All window expressions share one specification, so the plan has a single
exchange on (store, item), one sort and one Window node.  Silver holds at
most one row per (date, store, item), so the largest window partition is
bounded by the number of calendar days in the data, not by data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandlake import config
from demandlake.functions import columns as C


def series_window():
    return Window.partitionBy(*config.SERIES).orderBy("date")


def calendar_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "day_of_week": C.day_of_week("date"),
            "week_of_year": C.week_of_year("date"),
            "month": F.month("date"),
        }
    )


def lag_features(df: DataFrame, lags=config.LAGS) -> DataFrame:
    """``sales`` k rows earlier in the series (rows, not days)."""
    w = series_window()
    return df.withColumns({f"sales_lag_{k}": F.lag("sales", k).over(w) for k in lags})


def rolling_means(df: DataFrame, widths=config.ROLLING) -> DataFrame:
    """Mean of the previous k rows, current row excluded; partial at series
    start and NULL on the first row."""
    w = series_window()
    return df.withColumns(
        {f"sales_roll_mean_{k}": F.avg("sales").over(w.rowsBetween(-k, -1)) for k in widths}
    )


def project_gold(df: DataFrame) -> DataFrame:
    return df.select(*config.GOLD_COLUMNS)


def build_features(silver: DataFrame) -> DataFrame:
    """Silver -> gold feature table (calendar + lags + trailing means)."""
    return project_gold(rolling_means(lag_features(calendar_features(silver))))
