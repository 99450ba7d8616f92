"""Date and time expressions. "Now" is always an argument, never the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PER_DAY = {"day": 1, "hour": 24, "minute": 1440, "second": 86400}


def unit_index(ts: Column, unit: str) -> Column:
    """Whole units since 1970, from calendar fields (no session-zone conversion)."""
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    parts = days * _PER_DAY[unit]
    if unit == "hour":
        parts += F.hour(ts)
    elif unit == "minute":
        parts += F.hour(ts) * 60 + F.minute(ts)
    elif unit == "second":
        parts += F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return parts


def fn_datetime_diff(unit: str, a: Column, b: Column) -> Column:
    """Unit boundaries crossed from ``b`` to ``a`` (both truncated to the unit first)."""
    return unit_index(a, unit) - unit_index(b, unit)


def time_bucket(ts: Column, minutes: int) -> Column:
    """Number of the ``minutes`` wide time slice that holds ``ts``."""
    return F.floor(unit_index(ts, "minute") / minutes)


def fn_timezone(ts: Column, zone: str, to: str = "UTC") -> Column:
    """Read a zone-less time as local time of ``zone`` and give the wall time in ``to``."""
    return F.convert_timezone(F.lit(zone), F.lit(to), ts)


def fiscal_year_start(year: Column) -> Column:
    """The Monday nearest to 1 February."""
    return F.date_trunc("week", F.date_add(F.make_date(year, F.lit(2), F.lit(1)), 3)).cast("date")


def fiscal_year(day: Column) -> Column:
    year = F.year(day)
    return F.when(day >= fiscal_year_start(year), year).otherwise(year - 1)


def fiscal_week(day: Column, start: Column | str | None = None) -> Column:
    """1 + whole weeks since ``start`` (default: the start of the fiscal year of ``day``)."""
    if start is None:
        start = fiscal_year_start(fiscal_year(day))
    elif isinstance(start, str):
        start = F.lit(start).cast("date")
    return F.floor(F.datediff(day, start) / 7) + 1


def fiscal_week_key(day: Column) -> Column:
    """Year and week as text, so that it compares in time order: '202107'."""
    return F.concat(fiscal_year(day).cast("string"), F.lpad(fiscal_week(day).cast("string"), 2, "0"))


def job_age_days(job_end: Column, follow_up: Column, started: Column, as_of: str) -> Column:
    """Days from ``started`` to the first of job end, follow-up and the day before ``as_of``."""
    yesterday = F.date_sub(F.lit(as_of).cast("date"), 1)
    until = F.coalesce(job_end.cast("date"), follow_up.cast("date"), yesterday)
    return F.datediff(until, started.cast("date")).cast("long")
