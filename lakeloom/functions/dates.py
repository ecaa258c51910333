"""Date and time functions (inventory T1-T12).

Range predicates (``in_year``/``in_month``/``between_dates``) are written on
the bare column so Parquet min/max statistics and partition pruning apply;
``year(d) = 2024`` only pushes ``IsNotNull(d)`` down.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions._util import as_col, lit_or_col


# T1 ---------------------------------------------------------------------
def to_date(c, fmt: str | None = None, strict: bool = False) -> Column:
    """Parse to DATE. Bad input gives NULL unless ``strict`` (ANSI raise)."""
    c = as_col(c)
    if strict:
        return F.to_date(c, fmt) if fmt else F.to_date(c)
    return F.try_to_date(c, fmt) if fmt else F.try_to_date(c)


def to_timestamp(c, fmt: str | None = None, strict: bool = False) -> Column:
    c = as_col(c)
    if strict:
        return F.to_timestamp(c, fmt) if fmt else F.to_timestamp(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


# T2 / T3 ----------------------------------------------------------------
def year(c) -> Column:
    return F.year(as_col(c))


def month(c) -> Column:
    return F.month(as_col(c))


def day(c) -> Column:
    return F.dayofmonth(as_col(c))


def day_of_week(c) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(as_col(c))


def day_of_year(c) -> Column:
    return F.dayofyear(as_col(c))


def iso_week(c) -> Column:
    return F.weekofyear(as_col(c))


def quarter(c) -> Column:
    return F.quarter(as_col(c))


# T4-T7 ------------------------------------------------------------------
def last_day(c) -> Column:
    return F.last_day(as_col(c))


def next_day(c, weekday: str) -> Column:
    return F.next_day(as_col(c), weekday)


def add_months(c, n) -> Column:
    return F.add_months(as_col(c), n)


def add_days(c, n) -> Column:
    return F.date_add(as_col(c), n)


def sub_days(c, n) -> Column:
    return F.date_sub(as_col(c), n)


def days_between(end, start) -> Column:
    """Whole days from ``start`` to ``end`` (end first, like SQL datediff)."""
    return F.datediff(as_col(end), as_col(start))


def months_between(end, start, round_off: bool = True) -> Column:
    return F.months_between(as_col(end), as_col(start), round_off)


# T8 / T9 ----------------------------------------------------------------
def format_date(c, fmt: str) -> Column:
    """``MM`` is month, ``mm`` is minute."""
    return F.date_format(as_col(c), fmt)


def hour(c) -> Column:
    return F.hour(as_col(c))


def minute(c) -> Column:
    return F.minute(as_col(c))


def second(c) -> Column:
    return F.second(as_col(c))


# T10 --------------------------------------------------------------------
def ntz_literal(ts: _dt.datetime | str) -> Column:
    """A wall-clock TIMESTAMP_NTZ literal, independent of the Python process
    and Spark session time zones (a naive ``datetime`` passed to ``lit``
    would be read as process-local time and shown in the session zone)."""
    text = ts if isinstance(ts, str) else ts.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def run_time(ts: _dt.datetime | str | None = None) -> Column:
    """The pipeline's run time: a literal passed in by the caller so results
    are reproducible; ``current_timestamp()`` only when none is given."""
    if ts is None:
        return F.current_timestamp()
    return ntz_literal(ts)


def run_date(d: _dt.date | str | None = None) -> Column:
    if d is None:
        return F.current_date()
    return F.to_date(F.lit(str(d)))


# T11 --------------------------------------------------------------------
def trunc_day(c) -> Column:
    return F.to_date(as_col(c))


def trunc(c, unit: str) -> Column:
    """Truncate to year/quarter/month/week/day/hour/...; returns a timestamp."""
    return F.date_trunc(unit, as_col(c))


def is_midnight(c) -> Column:
    c = as_col(c)
    return (F.hour(c) == 0) & (F.minute(c) == 0) & (F.second(c) == 0)


# T12 and pushdown-friendly predicates -------------------------------------
def date_lit(s: str) -> Column:
    return F.to_date(F.lit(s))


def between_dates(c, start: str, end: str, inclusive_end: bool = True) -> Column:
    """Range on the bare column; works for DATE, TIMESTAMP and TIMESTAMP_NTZ
    because the literal bound is compared to the column type."""
    c = as_col(c)
    lo = c >= F.lit(start).cast("date")
    if inclusive_end:
        end_d = (_dt.date.fromisoformat(end) + _dt.timedelta(days=1)).isoformat()
        return lo & (c < F.lit(end_d).cast("date"))
    return lo & (c < F.lit(end).cast("date"))


def in_year(c, y: int) -> Column:
    """``year(c) = y`` written as a range so it pushes down."""
    c = as_col(c)
    return (c >= F.lit(f"{y:04d}-01-01").cast("date")) & (c < F.lit(f"{y + 1:04d}-01-01").cast("date"))


def in_month(c, y: int, m: int) -> Column:
    c = as_col(c)
    ny, nm = (y + 1, 1) if m == 12 else (y, m + 1)
    return (c >= F.lit(f"{y:04d}-{m:02d}-01").cast("date")) & (c < F.lit(f"{ny:04d}-{nm:02d}-01").cast("date"))


def week_end_sunday(c) -> Column:
    """Label of the pandas ``'W'`` (= ``W-SUN``) bin holding ``c``: the
    Sunday that ends its Monday-to-Sunday week."""
    return F.date_add(F.to_date(F.date_trunc("week", as_col(c))), 6)


def date_key(c) -> Column:
    """yyyymmdd integer surrogate key for a date dimension."""
    c = as_col(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")
