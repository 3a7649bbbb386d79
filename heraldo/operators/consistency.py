"""Whether what was read of an announcement fits what its text says: flags for a second look. Column functions.

Events are structs of date, end_date (dates), start_time, event_type (text), is_recurring and sessions (structs with a
date). Without the day of publishing, rules that need a calendar day count instead, or say nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heraldo.functions import dates, resolve
from heraldo.functions.mentions import mentions

# The flags, in the order of their rules, and kinds of events whose night has several hours.
DATES_WITHOUT_EVENT, TIME_NOT_READ, RANGE_AS_ONE_DAY, TIMES_OVER_EVENTS = "fechas sin evento", "hora sin leer", "rango como un día", "más horas que eventos"
LIST_NOT_READ, DAY_WITHOUT_EVENT, RELATIVE_WITHOUT_EVENT, BEFORE_POST = "lista de fechas sin leer", "día sin evento", "día relativo sin evento", "antes de la publicación"
WHOLE_NIGHTS = ["social", "party"]
MANY_STARTS = 3
EVENT = "struct<date:date,end_date:date,start_time:string,event_type:string,is_recurring:boolean,sessions:array<struct<date:date>>>"


def covers(event: Column, day: Column) -> Column:
    """Whether an event is on a day: its date, a day of its range, or one of its sessions."""
    within = (event["date"] <= day) & (day <= F.coalesce(event["end_date"], event["date"]))
    return F.coalesce(within, F.lit(False)) | F.coalesce(F.exists(event["sessions"], lambda s: s["date"] == day), F.lit(False))


def occasions(event: Column) -> Column:
    """How many days an event takes."""
    several, whole = F.coalesce(F.size(event["sessions"]), F.lit(0)), F.datediff(event["end_date"], event["date"]) + 1
    return F.when(several > 0, several).otherwise(F.coalesce(whole, F.lit(1)))


def dial(starts: Column) -> Column:
    """Clock times on a dial of twelve hours, each once: a printed 8:30 and 8:30 pm are one."""
    return F.array_distinct(F.transform(starts, lambda t: F.concat(F.lpad((F.substring(t, 1, 2).cast("int") % 12).cast("string"), 2, "0"), F.substring(t, 3, 3))))


def flagged(readings: DataFrame) -> DataFrame:
    """readings (caption, published, events, ...) with `flags`, in the order of the rules.

    A null caption names nothing, null events are none, without `published` rules that need a calendar day count or stay out.
    """
    some = lambda xs: F.coalesce(F.size(xs) > 0, F.lit(False))
    rows = readings.select(F.struct("*").alias("row"), "caption", "published", mentions(F.col("caption")).alias("said"), F.coalesce("events", F.array().cast(f"array<{EVENT}>")).alias("events"))
    rows = rows.withColumn("kept", F.filter("events", lambda e: ~F.coalesce(e["is_recurring"], F.lit(False))))
    published, kept = F.col("published"), F.col("kept")
    covered = lambda day: F.exists(kept, lambda e: covers(e, day))
    uncovered = lambda days: F.coalesce(F.exists(days, lambda d: (d >= published) & ~covered(d)), F.lit(False))
    real = lambda pairs: F.filter(F.transform(pairs, lambda p: dates.day_after(p["day"], p["month"], published)), lambda d: d.isNotNull())
    day_of = lambda x: F.filter(F.transform(x["days"], lambda d: dates.day_after(d, x["month"], published)), lambda d: d.isNotNull())
    rows = rows.withColumn("dated", F.filter(real(F.col("said.dates")), lambda d: d >= published)).withColumn("ranged", real(F.col("said.ranges")))
    rows = rows.withColumn("named", resolve.weekday_dates(F.col("caption"), published))
    rows = rows.withColumn("relative", resolve.relative_days(F.col("caption"), published, F.concat("named", "dated")))
    known = published.isNotNull()

    without = F.when(known, some(F.col("dated"))).otherwise(some(F.col("said.dates"))) & ~some(kept)
    series = lambda e: F.coalesce(F.size(e["sessions"]) > 0, F.lit(False))
    open_start = F.exists(kept, lambda e: (series(e) | e["end_date"].isNull()) & (F.coalesce(e["start_time"], F.lit("")) == ""))
    whole = F.exists(kept, lambda e: e["end_date"].isNotNull() | series(e))
    one_day = some(kept) & F.when(known, uncovered(F.col("ranged"))).otherwise(some(F.col("said.ranges")) & ~whole)
    crowded = (F.size(dial(F.col("said.starts"))) >= MANY_STARTS) & (F.size(kept) == 1) & ~F.coalesce(F.try_element_at(kept, F.lit(1))["event_type"].isin(WHOLE_NIGHTS), F.lit(False))
    taken = F.aggregate(kept, F.lit(0), lambda n, e: n + occasions(e))
    listed = some(kept) & F.exists(F.col("said.lists"), lambda x: F.when(known, uncovered(day_of(x))).otherwise(F.size(x["days"]) > taken))
    unmet = some(F.col("relative")) & ~F.exists(F.col("relative"), lambda days: F.exists(days, covered))
    gone = F.exists(kept, lambda e: F.coalesce(e["end_date"], e["date"]) < published)
    rules = {
        DATES_WITHOUT_EVENT: without, TIME_NOT_READ: some(F.col("said.times")) & open_start, RANGE_AS_ONE_DAY: one_day, TIMES_OVER_EVENTS: crowded, LIST_NOT_READ: listed,
        DAY_WITHOUT_EVENT: known & some(kept) & uncovered(F.col("named")), RELATIVE_WITHOUT_EVENT: known & unmet, BEFORE_POST: known & gone,
    }
    flags = F.array_compact(F.array(*[F.when(F.coalesce(holds, F.lit(False)), F.lit(flag)) for flag, holds in rules.items()]))
    return rows.select("row.*", flags.alias("flags"))
