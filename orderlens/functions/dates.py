"""Date windows relative to an explicit ``as_of`` date (never the wall clock)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = dt.date | str


def as_date(as_of: AsOf) -> dt.date:
    return as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))


def lit_date(as_of: AsOf) -> Column:
    return F.lit(as_date(as_of))


def months_back(as_of: AsOf, months: int) -> Column:
    """``as_of - INTERVAL n MONTH`` (end-of-month clamped like SQL engines)."""
    return F.add_months(lit_date(as_of), -months)


def days_back(as_of: AsOf, days: int) -> Column:
    return F.date_sub(lit_date(as_of), days)


PARTITION_COLUMN = "order_month"   # 'yyyy-MM' partitions written by sources.files.write_table


def _month_bound(df: DataFrame, col: str) -> bool:
    return col == "order_date" and PARTITION_COLUMN in df.columns


def since(df: DataFrame, lower: Column, col: str = "order_date") -> DataFrame:
    """Trailing window: lower bound only (rows after ``as_of`` pass, as in the SQL).

    On a table partitioned by order month, the same bound is also stated on
    the partition column, so the scan skips older partitions.
    """
    out = df.filter(F.col(col) >= lower.cast("timestamp_ntz"))
    if _month_bound(df, col):
        out = out.filter(F.col(PARTITION_COLUMN) >= F.date_format(lower, "yyyy-MM"))
    return out


def between(df: DataFrame, lower: Column, upper: Column, col: str = "order_date") -> DataFrame:
    """Inclusive range on timestamps (bounds may be runtime values such as scalar subqueries);
    restated on the month partition column when present."""
    out = df.filter(F.col(col).between(lower, upper))
    if _month_bound(df, col):
        out = out.filter(F.col(PARTITION_COLUMN).between(F.date_format(lower, "yyyy-MM"),
                                                         F.date_format(upper, "yyyy-MM")))
    return out


def trailing(df: DataFrame, as_of: AsOf, months: int | None = None,
             days: int | None = None, col: str = "order_date") -> DataFrame:
    lower = months_back(as_of, months) if months is not None else days_back(as_of, days)
    return since(df, lower, col)


def day_range(df: DataFrame, start: AsOf | None, end: AsOf | None,
              col: str = "order_date", end_inclusive_day: bool = True) -> DataFrame:
    """Half-open calendar range ``[start, end + 1 day)`` (prunable, no ``to_date(col)``).

    ``end_inclusive_day=False`` keeps the text-comparison behaviour of the
    reference database, where ``order_date <= 'YYYY-MM-DD'`` stops at midnight.
    """
    pruned = _month_bound(df, col)
    if start is not None:
        df = since(df, lit_date(start), col)
    if end is not None:
        if end_inclusive_day:
            df = df.filter(F.col(col) < F.date_add(lit_date(end), 1).cast("timestamp_ntz"))
        else:
            df = df.filter(F.col(col) <= lit_date(end).cast("timestamp_ntz"))
        if pruned:
            df = df.filter(F.col(PARTITION_COLUMN) <= F.date_format(lit_date(end), "yyyy-MM"))
    return df


def calendar_days(later: Column, earlier: Column) -> Column:
    """SQL ``DATEDIFF``: difference of the date parts."""
    return F.datediff(later, earlier)


def elapsed_days(later: Column, earlier: Column) -> Column:
    """pandas ``(a - b).dt.days``: whole elapsed days, floored."""
    return F.timestamp_diff("DAY", earlier, later)


def month_label(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def day_name(c: Column) -> Column:
    """Full English day name ('Monday'); Spark's ``dayname`` is abbreviated."""
    return F.date_format(c, "EEEE")


def weekday_mon0(c: Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(c)


_EPOCH_NTZ = "1970-01-01 00:00:00"


def ntz_as_instant(c: Column) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP reading the wall clock as UTC, whatever the session time zone.

    (A plain cast would read it in the session time zone.)  Streaming event
    time must be a TIMESTAMP for watermarks.
    """
    micros = F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), c)
    return F.timestamp_micros(micros)


def instant_as_ntz(c: Column) -> Column:
    """Inverse of ``ntz_as_instant``: TIMESTAMP -> UTC wall clock as TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))
