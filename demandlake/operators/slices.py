"""Relative date windows and slices, kept inside the plan.

``max(date)`` is a scalar subquery of the DataFrame rather than a value
collected to the driver, so a filter such as ``date >= max(date) - 30``
is one query.

Every function takes a DataFrame or a ``Dated`` table.  Of a ``Dated`` table
the maximum comes from the files' statistics, and the window also bounds the
month column, so only the folders of the window's months are opened.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake import config


@dataclass(frozen=True)
class Dated:
    """A table stored in month folders: ``rows`` with the month column
    (``yyyy-MM`` of ``date``), ``stats`` the same files opened for their
    statistics (``io.statistics``)."""

    rows: DataFrame
    stats: DataFrame
    month: str

    @property
    def plain(self) -> DataFrame:
        return self.rows.drop(self.month)


def _rows(t: DataFrame | Dated) -> DataFrame:
    return t.rows if isinstance(t, Dated) else t


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def window(t: DataFrame | Dated, on_date: Column, on_month: Callable[[Column], Column], c: str = "date") -> DataFrame:
    """Rows for which ``on_date`` holds.  Of a ``Dated`` table only the
    folders for which ``on_month`` holds are opened; it must be no stricter."""
    out = _rows(t).filter(on_date)
    if not isinstance(t, Dated):
        return out
    return (out.filter(on_month(F.col(t.month))) if c == "date" else out).drop(t.month)


def max_of(t: DataFrame | Dated, c: str = "date") -> Column:
    """``max(c)`` of the table as a scalar-subquery column."""
    return (t.stats if isinstance(t, Dated) else t).agg(F.max(c)).scalar()


def cutoff(t: DataFrame | Dated, days: int, c: str = "date") -> Column:
    return F.date_sub(max_of(t, c), days)


def before(t: DataFrame | Dated, days: int, c: str = "date") -> DataFrame:
    """Rows strictly before ``max(c) - days``."""
    cut = cutoff(t, days, c)
    return window(t, F.col(c) < cut, lambda month: month <= month_of(cut), c)


def since(t: DataFrame | Dated, days: int, c: str = "date") -> DataFrame:
    """Rows on or after ``max(c) - days`` (days + 1 calendar days inclusive)."""
    cut = cutoff(t, days, c)
    return window(t, F.col(c) >= cut, lambda month: month >= month_of(cut), c)


def split_holdout(t: DataFrame | Dated, days: int = config.HOLDOUT_DAYS, c: str = "date") -> tuple[DataFrame, DataFrame]:
    """Time-based holdout: (train before max-days, test on/after max-days)."""
    return before(t, days, c), since(t, days, c)


def split_counts(t: DataFrame | Dated, days: int = config.HOLDOUT_DAYS, c: str = "date") -> DataFrame:
    """Train and test row counts in a single pass."""
    cut = cutoff(t, days, c)
    return _rows(t).agg(
        F.count_if(F.col(c) < cut).alias("train_rows"),
        F.count_if(F.col(c) >= cut).alias("test_rows"),
    )


def latest_slice(t: DataFrame | Dated, c: str = "date") -> DataFrame:
    """Rows whose ``c`` equals the table's maximum (latest day or batch)."""
    last = max_of(t, c)
    return window(t, F.col(c) == last, lambda month: month == month_of(last), c)


def complete_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Project ``cols`` and drop rows with any NULL or NaN among them."""
    return df.select(*cols).dropna(how="any")


def require_rows(df: DataFrame, what: str = "this step") -> DataFrame:
    """Fail at the job boundary when a table is empty (one tiny job, meant
    for written tables; for a slice see ``required``)."""
    if df.isEmpty():
        raise RuntimeError(f"{what}: the selected window has no rows")
    return df


def required(aggregated: DataFrame, count: str, what: str = "this step") -> DataFrame:
    """The guard inside the plan: an ungrouped aggregate over a slice, which
    fails while it is evaluated when its ``count`` column is 0.  The slice
    runs once, for the aggregate itself."""
    message = F.lit(f"{what}: the selected window has no rows")
    checked = F.when(F.col(count) > 0, F.col(count)).otherwise(F.raise_error(message).cast("long"))
    return aggregated.withColumn(count, checked).filter(F.col(count) > 0)
