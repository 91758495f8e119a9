"""Expressions on dates and times. The session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day 0 of the day numbers, which is also the date written for unreadable dates.
DAY_ZERO = "1960-01-01"
# Day numbers that fall in the years 1 to 9999.
FIRST_DAY, LAST_DAY = -715509, 2936549

CALENDAR = ["hour", "day", "week", "month", "year", "weekday"]


def millis_text(c: Column) -> Column:
    """Epoch milliseconds as ``yyyy-MM-dd HH:mm:ss.SSS``."""
    return F.date_format(F.timestamp_millis(c), "yyyy-MM-dd HH:mm:ss.SSS")


def sas_date(c: Column, default: str = DAY_ZERO) -> Column:
    """Days since 1960-01-01 as date; ``default`` when null, not a number or out of range."""
    day = F.floor(F.when(~F.isnan(c), c))
    return F.when(
        day.between(FIRST_DAY, LAST_DAY), F.date_add(F.lit(DAY_ZERO).cast("date"), day.cast("int"))
    ).otherwise(F.lit(default).cast("date"))


def parse_date(c: Column, fmt: str, default: str = DAY_ZERO) -> Column:
    """Text as date by a Spark pattern; ``default`` when null or unreadable (such as ``D/S``)."""
    return F.coalesce(F.try_to_date(c, fmt), F.lit(default).cast("date"))


def weekday_number(ts: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(ts) - 1


def time_parts(ts: Column, weekday: str = "name") -> dict[str, Column]:
    """The calendar columns of a time; ``week`` is the ISO week, ``weekday`` a name or a number."""
    return {
        "hour": F.hour(ts),
        "day": F.dayofmonth(ts),
        "week": F.weekofyear(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        "weekday": F.date_format(ts, "EEEE") if weekday == "name" else weekday_number(ts),
    }


def time_map(ts: Column) -> Column:
    """The calendar columns as one map of texts."""
    entries = [e for name, c in time_parts(ts).items() for e in (F.lit(name), c.cast("string"))]
    return F.create_map(*entries)
