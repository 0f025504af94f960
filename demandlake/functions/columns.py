"""Column expressions.  All are built-in Spark expressions, so they stay
inside whole-stage code generation; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandlake import config


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_date(c: str | Column) -> Column:
    """String -> DATE, malformed -> NULL (ANSI-safe ``try_cast``)."""
    return col_(c).try_cast("date")


def lenient_int(c: str | Column) -> Column:
    """String -> INT; decimal text is cut at the point, whatever follows it
    ('13.7' -> 13, '-2.5' -> -2, '.9' -> 0); malformed or out of range ->
    NULL.  Spaces and control characters around the number do not count."""
    around = r"[\x00-\x20\x7F]*"
    whole = F.regexp_extract(col_(c).cast("string"), rf"\A{around}([+-]?[0-9]*)\.[0-9]*{around}\z", 1)
    cut = F.when(whole.isin("+", "-"), F.lit(0)).otherwise(whole.try_cast("int"))
    only_fraction = col_(c).cast("string").rlike(rf"\A{around}\.[0-9]*{around}\z")
    return F.coalesce(col_(c).try_cast("int"), F.when(only_fraction, F.lit(0)).otherwise(cut))


def hash_bucket(keys: Sequence[str | Column], buckets: int = config.PROMO_BUCKETS) -> Column:
    """Deterministic bucket 0..buckets-1 of the business keys.

    Murmur3 (seed 42) over the keys in order, absolute value taken on a
    BIGINT so that INT_MIN does not overflow under ANSI mode.
    """
    return F.abs(F.hash(*[col_(k) for k in keys]).cast("long")) % F.lit(buckets)


def promo_flag(bucket: str | Column, cutoff: int = config.PROMO_CUTOFF) -> Column:
    return F.when(col_(bucket) < cutoff, F.lit(1)).otherwise(F.lit(0))


def promo_discount(
    bucket: str | Column, flag: str | Column, max_discount: float = config.PROMO_MAX_DISCOUNT
) -> Column:
    return F.when(col_(flag) == 1, (col_(bucket) / F.lit(100.0)) * F.lit(max_discount)).otherwise(F.lit(0.0))


def clamp_non_negative(c: str | Column) -> Column:
    """NULL or negative -> 0."""
    c = col_(c)
    return F.when(c.isNull() | (c < 0), F.lit(0)).otherwise(c)


def default_if_null(c: str | Column, value) -> Column:
    return F.coalesce(col_(c), F.lit(value))


def day_of_week(c: str | Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(col_(c))


def week_of_year(c: str | Column) -> Column:
    """ISO-8601 week number."""
    return F.weekofyear(col_(c))


def linear_score(coefficients: Mapping[str, float], intercept: float) -> Column:
    """intercept + sum(coef * x) evaluated left to right in the given order.

    A linear model given as constants, so the same arithmetic can be
    written in SQL."""
    expr = F.lit(float(intercept))
    for name, coef in coefficients.items():
        expr = expr + F.lit(float(coef)) * F.col(name).cast("double")
    return expr
