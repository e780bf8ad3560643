"""Day-partition arithmetic.

Warehouse days are ``yyyyMMdd`` strings.  Bounds for partition filters are
computed once on the driver (plain Python), so the filter compares strings and
Catalyst prunes partitions without a cast.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FMT = "%Y%m%d"


def day_minus(day: str, n: int) -> str:
    """``yyyyMMdd`` minus ``n`` calendar days (20201230 - 7 -> 20201223)."""
    d = _dt.datetime.strptime(day, DAY_FMT).date() - _dt.timedelta(days=n)
    return d.strftime(DAY_FMT)


def day_range(first: str, last: str) -> list[str]:
    """All days from ``first`` to ``last``, both included."""
    n = (_dt.datetime.strptime(last, DAY_FMT) - _dt.datetime.strptime(first, DAY_FMT)).days
    return [day_minus(last, k) for k in range(n, -1, -1)]


def window_bounds(day: str, n: int, inclusive: bool = True) -> tuple[str, str]:
    """(low, high) day strings of an ``n``-day window ending on ``day``.

    ``inclusive=True`` reproduces the warehouse rule ``between day-n and day``,
    which spans n+1 partitions (7 -> 8 days, 30 -> 31 days).  ``False`` gives
    exactly ``n`` partitions.
    """
    return (day_minus(day, n if inclusive else n - 1), day)


def day_minus_col(day: Column, n: int) -> Column:
    """Column form of :func:`day_minus`."""
    return F.date_format(F.date_sub(F.to_date(day, "yyyyMMdd"), n), "yyyyMMdd")


def day_number(day: Column) -> Column:
    """Days since 1970-01-01 for a ``yyyyMMdd`` string (for RANGE frames)."""
    return F.unix_date(F.to_date(day, "yyyyMMdd"))


def day_string(day_num: Column) -> Column:
    """Inverse of :func:`day_number`."""
    return F.date_format(F.date_from_unix_date(day_num), "yyyyMMdd")
