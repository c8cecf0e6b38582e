"""Calendar helpers that keep predicates pushable to the Parquet scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_bounds(year: int, month: int) -> tuple[dt.datetime, dt.datetime]:
    """Half-open [first instant, first instant of next month)."""
    start = dt.datetime(year, month, 1)
    end = dt.datetime(year + (month == 12), month % 12 + 1, 1)
    return start, end


def in_month(col: str, year: int, month: int) -> Column:
    """``year(col) = Y AND month(col) = M`` written as a range so both bounds
    reach the Parquet reader as ``GreaterThanOrEqual``/``LessThan`` (the
    function form only pushes ``IsNotNull``)."""
    start, end = month_bounds(year, month)
    return (F.col(col) >= ntz_literal(start)) & (F.col(col) < ntz_literal(end))


def ntz_literal(value: dt.datetime) -> Column:
    """Wall-clock TIMESTAMP_NTZ literal.  ``F.lit(datetime)`` would build a
    zoned TIMESTAMP from the Python process's time zone and compare it with
    NTZ columns through the session time zone."""
    return F.expr(f"TIMESTAMP_NTZ '{value:%Y-%m-%d %H:%M:%S.%f}'")


def days_to_next_year(col: str) -> Column:
    """Whole days from a timestamp's date to the same date one year on; 29 February goes to
    28 February."""
    day = F.col(col).cast("date")
    return F.date_diff(F.add_months(day, 12), day)


def shift_days(col: str, days: Column) -> Column:
    """Move a timestamp by whole days keeping the time of day (a plain
    ``date_add`` would truncate it to midnight)."""
    return F.col(col) + F.make_dt_interval(days)


def month_start(year: str = "year", month: str = "month") -> Column:
    return F.make_date(F.col(year), F.col(month), F.lit(1))
