"""Column functions on days and moments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_ZONE, QUOTA_ZONE = "America/Bogota", "America/Los_Angeles"


def local_day(moment: Column, zone: str = DAY_ZONE) -> Column:
    """The day of a UTC moment in a zone."""
    return F.to_date(F.from_utc_timestamp(moment, zone))


def days_of(first: Column, last: Column, sessions: Column | None = None) -> Column:
    """An event's days: its sessions' dates, or every day from the first to the last."""
    span = F.when(first.isNotNull(), F.sequence(first, F.greatest(first, F.coalesce(last, first))))
    return span if sessions is None else F.when(F.size(sessions) > 0, F.transform(sessions, lambda s: s["date"])).otherwise(span)


def weekend(day: Column) -> Column:
    """struct(first, last): the coming Friday to Sunday, or the current one from Friday on."""
    friday = F.date_add(day, 4 - F.weekday(day))
    return F.struct(friday.alias("first"), F.date_add(friday, 2).alias("last"))


def occurrence(days: Column, first: Column, last: Column) -> Column:
    """The first of some days within a range, or null."""
    return F.array_min(F.filter(days, lambda d: (d >= first) & (d <= last)))


def day_after(day: Column, month: Column, published: Column) -> Column:
    """A day and month without a year, in the year that fits when it was published: the next one if the month is well before."""
    year = F.year(published) + F.when(month < F.month(published) - 1, 1).otherwise(0)
    return F.try_to_timestamp(F.format_string("%04d-%02d-%02d", year, month, day), F.lit("yyyy-MM-dd")).cast("date")
