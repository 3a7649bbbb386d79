"""Workshop series: an event's sessions read, fitted to its days, and checked. Column functions on arrays of structs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heraldo.functions import text
from heraldo.operators.announcements import MAX_DAYS

LEAST_SESSIONS, MOST_SESSIONS, MOST_SERIES_DAYS = 2, 12, 123
COURSE_DOUBT = f"más de {MOST_SESSIONS} sesiones o más de 4 meses: es un curso"
BAD_TIME = "Hora de inicio no reconocida: "
# The days of a week, Monday first.
WEEKDAYS = "lunes martes miércoles jueves viernes sábado domingo".split()


def weekday_name(day: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.weekday(day) + 1)


def parsed_sessions(sessions: Column, start: Column, end: Column) -> Column:
    """Sessions (date, start_time, end_time as text) by real days, the first of each day, in order; null for fewer than two.

    A session without a time takes the event's; one whose time can't be read has none.
    """
    own = lambda written, event: F.coalesce(text.clock(written), F.when(F.coalesce(written, F.lit("")) == "", event))
    read = F.transform(sessions, lambda s, i: F.struct(text.iso_date(s["date"]).alias("date"), i.alias("place"), own(s["start_time"], start).alias("start_time"), own(s["end_time"], end).alias("end_time")))
    ordered = F.array_sort(F.filter(read, lambda s: s["date"].isNotNull()))
    firsts = F.filter(ordered, lambda s, i: (i == 0) | (s["date"] != F.try_element_at(ordered, F.greatest(i, F.lit(1)))["date"]))
    plain = F.transform(firsts, lambda s: F.struct(s["date"].alias("date"), s["start_time"].alias("start_time"), s["end_time"].alias("end_time")))
    return F.when(F.size(plain) >= LEAST_SESSIONS, plain)


def session_doubts(sessions: Column) -> Column:
    """What can't be read of the sessions' starts, in order."""
    bad = F.filter(sessions, lambda s: (s["start_time"] != "") & text.clock(s["start_time"]).isNull() & text.iso_date(s["date"]).isNotNull())
    return F.coalesce(F.transform(bad, lambda s: F.concat(F.lit(BAD_TIME), s["start_time"])), F.array().cast("array<string>"))


def consecutive(days: Column) -> Column:
    """Whether ordered days follow each other without a gap."""
    return F.datediff(F.element_at(days, -1), F.element_at(days, 1)) == F.size(days) - 1


def increasing(days: Column) -> Column:
    return days == F.array_sort(F.array_distinct(days))


def fit_sessions(events: DataFrame) -> DataFrame:
    """events with parsed `sessions` whose days, times, weekday, is_recurring and doubts follow them.

    Days in a row are an event over several days; too many sessions, or over too long, are a course, which recurs.
    """
    days, first = F.transform("sessions", lambda s: s["date"]), F.try_element_at(F.col("sessions"), F.lit(1))
    last = F.try_element_at(days, F.lit(-1))
    several = F.coalesce(F.size("sessions") >= 1, F.lit(False))
    run = several & consecutive(days) & (F.size("sessions") <= MAX_DAYS)
    course = several & ~run & ((F.size("sessions") > MOST_SESSIONS) | (F.datediff(last, first["date"]) + 1 > MOST_SERIES_DAYS))
    series = several & ~run & ~course
    dated = run | series
    pick = lambda when, new, old: F.when(when, new).otherwise(F.col(old)).alias(old)
    own = {
        "date": pick(dated, first["date"], "date"), "end_date": pick(dated, last, "end_date"),
        "start_time": pick(series, first["start_time"], "start_time"), "end_time": pick(series, first["end_time"], "end_time"),
        "weekday": pick(series, weekday_name(first["date"]), "weekday"), "is_recurring": pick(course, F.lit(True), "is_recurring"),
        "doubts": pick(course, F.concat(F.coalesce("doubts", F.array().cast("array<string>")), F.array(F.lit(COURSE_DOUBT))), "doubts"), "sessions": F.when(series, F.col("sessions")).alias("sessions"),
    }
    return events.select(*[own.get(c, F.col(c)) for c in events.columns])


def series_problems(sessions: Column, date: Column, end_date: Column) -> Column:
    """What breaks the rules of a series, as an array: count, days, order, span, and days that don't frame it; null sessions break none."""
    days = F.transform(sessions, lambda s: s["date"])
    known = ~F.exists(days, lambda d: d.isNull())
    first, last = F.try_element_at(days, F.lit(1)), F.try_element_at(days, F.lit(-1))
    found = F.array_compact(F.array(
        F.when(~F.size(sessions).between(LEAST_SESSIONS, MOST_SESSIONS), "count"),
        F.when(~known, "day unknown").when(~increasing(days), "out of order").when(F.datediff(last, first) + 1 > MOST_SERIES_DAYS, "too long"),
        F.when((F.size(sessions) > 0) & ~(date.eqNullSafe(first) & end_date.eqNullSafe(last)), "days don't frame it"),
    ))
    return F.when(sessions.isNull(), F.array().cast("array<string>")).otherwise(found)
