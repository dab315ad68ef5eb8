"""Row filters and date-window predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions.scalars import as_date, month_start


def look_back(df: DataFrame, as_of, days: int, column: str = "date") -> DataFrame:
    """Rows dated ``days`` before ``as_of`` or later."""
    return df.filter(F.col(column) >= F.date_sub(as_date(as_of), days))


def from_date(df: DataFrame, as_of, column: str = "date") -> DataFrame:
    return df.filter(F.col(column) >= as_date(as_of))


def month_of(df: DataFrame, as_of, column: str = "date") -> DataFrame:
    """Rows in the calendar month of ``as_of``.

    Written as a range on the bare column, so it prunes partitions and reaches the scan.
    """
    first = month_start(as_date(as_of))
    return df.filter((F.col(column) >= first) & (F.col(column) < F.add_months(first, 1)))


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a value in each of ``columns``."""
    cond: Column = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with a null (or NaN) in any column."""
    return df.dropna()


def restrict_to_dates(df: DataFrame, dates: DataFrame, column: str = "date") -> DataFrame:
    """Keep rows whose date is in ``dates``.

    The set is made distinct first; adaptive execution broadcasts it if it is small.
    """
    return df.join(dates.select(column).distinct(), column, "left_semi")
