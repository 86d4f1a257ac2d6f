"""Time functions: bucket registry and chain, month key, display format.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _trunc(unit: str) -> Callable[[Column], Column]:
    # date_trunc yields a zoned TIMESTAMP; cast back so a TIMESTAMP_NTZ input stays zone-less.
    return lambda c: F.date_trunc(unit, c).cast("timestamp_ntz")


def _week_start(c: Column) -> Column:
    """The Sunday on or before a time, as a date."""
    day = F.to_date(c)
    return F.date_sub(day, F.dayofweek(day) - 1)


# The bucket function names a spec may use, each a unary Column → Column.
# Minutes, hours and days start at a time; weeks (Sundays), months and years at a date.
BUCKET_FUNCTIONS: dict[str, Callable[[Column], Column]] = {
    "toStartOfMinute": _trunc("minute"),
    "toStartOfHour": _trunc("hour"),
    "toStartOfDay": _trunc("day"),
    "toStartOfWeek": _week_start,
    "toStartOfMonth": lambda c: F.trunc(c, "month"),
    "toStartOfYear": lambda c: F.trunc(c, "year"),
    "toDate": F.to_date,
    "toYYYYMM": lambda c: yyyymm(c),
}


def bucket(ts: Column | str, functions: Sequence[str]) -> Column:
    """Apply a bucket-function chain right to left: ``[toDate, toStartOfDay]`` → toDate(toStartOfDay(ts))."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return reduce(lambda acc, name: BUCKET_FUNCTIONS[name](acc), reversed(list(functions)), col)


def yyyymm(ts: Column | str) -> Column:
    """Integer month key, e.g. 202401; the fact-table partition column."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return (F.year(col) * 100 + F.month(col)).cast("int")


def as_time(value: dt.datetime | dt.date | str) -> dt.datetime:
    """A literal bound as a time; a date is its midnight."""
    if isinstance(value, str):
        return dt.datetime.fromisoformat(value)
    return value if isinstance(value, dt.datetime) else dt.datetime(value.year, value.month, value.day)


def yyyymm_of(value: dt.datetime | dt.date | str) -> int:
    """Driver-side month key of a literal bound (for the implied partition predicate)."""
    time = as_time(value)
    return time.year * 100 + time.month


def month_range(lo=None, hi=None) -> tuple[int, int] | None:
    """First and last month of times from ``lo`` on and before ``hi``; None when both are open."""
    if lo is None and hi is None:
        return None
    last = 999912 if hi is None else yyyymm_of(as_time(hi) - dt.timedelta(microseconds=1))
    return (0 if lo is None else yyyymm_of(lo)), last


DISPLAY_FORMAT = "yyyy-MM-dd HH:mm:ss"


def display_time(ts: Column | str) -> Column:
    """``%Y-%m-%d %H:%M:%S`` text of a timestamp."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(col, DISPLAY_FORMAT)
