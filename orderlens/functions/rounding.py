"""Exact rounding rules.

SQL ``ROUND`` (half away from zero) and pandas/Python ``round`` (half to even)
are applied to DECIMAL values, never to doubles: ``round(2.345, 2)`` on a
double depends on its binary representation.  A ratio of two counts or a mean
of money is formed by DECIMAL division (``decimal(38, 14..20)`` in Spark), which
is exact far beyond the two output digits, and is cast to DOUBLE last.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT_DEC = "decimal(20,0)"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_dec(c: Column | str) -> Column:
    """Integral column to DECIMAL so that division stays exact."""
    return col_(c).cast(_INT_DEC)


def exact_ratio(num: Column, den: Column) -> Column:
    """num / den as DECIMAL (inputs integral or decimal); NULL when den is 0 or NULL."""
    return F.try_divide(num, den)


def exact_mean(c: Column | str, integral: bool = False) -> Column:
    """Mean that skips NULLs, as exact DECIMAL (aggregate expression)."""
    x = col_(c)
    # sum first, then widen: decimal(20,0) / count keeps 18 fractional digits
    total = F.sum(x).cast(_INT_DEC) if integral else F.sum(x)
    return F.try_divide(total, F.count(x))


def round_half_up(c: Column, digits: int = 2) -> Column:
    """SQL ROUND on an exact value, returned as DOUBLE."""
    return F.round(c, digits).cast("double")


def round_half_even(c: Column, digits: int = 2) -> Column:
    """Python/pandas-style rounding on an exact value, returned as DOUBLE."""
    return F.bround(c, digits).cast("double")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """ROUND(100 * part / whole, digits) for counts, exact, as DOUBLE.

    Rounded as ``ROUND(part / whole, digits + 2) * 100``: the same digit, and
    the quotient keeps 18 fractional digits (multiplying first would cut it to 7).
    """
    return (F.round(exact_ratio(as_dec(part), whole), digits + 2) * 100).cast("double")


def percent_change(cur: Column, prev: Column, digits: int = 2) -> Column:
    """ROUND((cur - prev) / prev * 100, digits) for counts or DECIMAL money, kept DECIMAL."""
    diff = cur - prev
    return F.round(exact_ratio(diff, prev), digits + 2) * 100


def mean_as_double(c: Column | str) -> Column:
    """Unrounded mean of a DECIMAL column: exact sum / count as DOUBLE (aggregate)."""
    x = col_(c)
    return F.try_divide(F.sum(x).cast("double"), F.count(x))
