"""Pinned parameters of the registered queries (so Spark and the SQL
oracle see the same clock and the same constant scorers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AS_OF = "2001-06-29"
LOAD_TS = "2001-07-01 00:00:00"
LOAD_TS_2 = "2001-07-02 00:00:00"
EVAL_TS = "2001-07-03 00:00:00"
EVAL_TS_2 = "2001-07-04 00:00:00"
ENV = "DEV"

# Two linear scorers given as constants (intercept first, then one
# coefficient per model feature in feature order).
BASELINE_INTERCEPT = 1.5
BASELINE_COEF = {
    "is_promo": 2.0,
    "discount_pct": 10.0,
    "day_of_week": 0.1,
    "week_of_year": 0.01,
    "month": 0.05,
    "sales_lag_7": 0.2,
    "sales_lag_14": 0.1,
    "sales_lag_28": 0.1,
    "sales_roll_mean_7": 0.3,
    "sales_roll_mean_28": 0.2,
}
CHALLENGER_INTERCEPT = 0.5
CHALLENGER_COEF = {
    "is_promo": 3.0,
    "discount_pct": 5.0,
    "day_of_week": 0.05,
    "week_of_year": 0.0,
    "month": 0.02,
    "sales_lag_7": 0.15,
    "sales_lag_14": 0.05,
    "sales_lag_28": 0.05,
    "sales_roll_mean_7": 0.45,
    "sales_roll_mean_28": 0.25,
}

FIXED_BASELINE_RUN = "run_fixed_baseline"
FIXED_CHALLENGER_RUN = "run_fixed_challenger"


def ts(value: str) -> Column:
    """A zone-free timestamp literal."""
    return F.expr(f"TIMESTAMP_NTZ '{value}'")


def day(value: str) -> Column:
    return F.expr(f"DATE '{value}'")
