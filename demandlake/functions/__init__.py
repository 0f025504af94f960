"""Column expressions used by the operators."""

from demandlake.functions.columns import (
    clamp_non_negative,
    day_of_week,
    default_if_null,
    hash_bucket,
    lenient_date,
    lenient_int,
    linear_score,
    promo_discount,
    promo_flag,
    week_of_year,
)

__all__ = [
    "clamp_non_negative",
    "day_of_week",
    "default_if_null",
    "hash_bucket",
    "lenient_date",
    "lenient_int",
    "linear_score",
    "promo_discount",
    "promo_flag",
    "week_of_year",
]
