"""Time buckets over whole seconds since 1970 (UTC), independent of the session's time zone."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventide.schema import DAY, HOUR


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(seconds) -> Column:
    return F.date_from_unix_date(F.floor(_col(seconds) / F.lit(DAY)).cast("int"))


def week(seconds) -> Column:
    """The Monday of the week."""
    return monday(day(seconds))


def monday(date: Column) -> Column:
    return F.date_sub(date, F.weekday(date))


def month(seconds) -> Column:
    return F.trunc(day(seconds), "month")


def bucket(seconds, grain: str) -> Column:
    made = {"day": day, "week": week, "month": month}
    if grain not in made:
        raise ValueError(f"grain must be one of {sorted(made)}")
    return made[grain](seconds)


def of_date(date: Column, grain: str) -> Column:
    return {"day": lambda d: d, "week": monday, "month": lambda d: F.trunc(d, "month")}[grain](date)


def shown(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def hour_of_day(seconds) -> Column:
    return F.floor(_col(seconds) % DAY / HOUR).cast("int")


def hour_start(seconds) -> Column:
    return _col(seconds) - _col(seconds) % HOUR


def hours_between(earlier, later) -> Column:
    """Hour boundaries crossed from earlier to later."""
    return F.floor(_col(later) / HOUR) - F.floor(_col(earlier) / HOUR)


def window_start(as_of: int, seconds: int) -> int:
    return max(as_of - seconds, 0)


def previous_hour(as_of: int) -> tuple[int, int]:
    """The last complete hour: first second, and the first second behind it."""
    end = as_of - as_of % HOUR
    return end - HOUR, end


def iso(seconds) -> Column:
    days = day(seconds)
    rest = (_col(seconds) % DAY).cast("int")
    part = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat(shown(days), F.lit("T"), part(F.floor(rest / 3600)), F.lit(":"), part(F.floor(rest % 3600 / 60)), F.lit(":"), part(rest % 60), F.lit("Z"))


def seconds_of(moment: str) -> int:
    """Seconds of an ISO date or date and time, UTC."""
    return int(datetime.fromisoformat(moment).replace(tzinfo=UTC).timestamp())
