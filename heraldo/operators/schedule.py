"""What to read next: who is due, who posts nothing useful, who announces late, and in which order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hours between two reads of a key: of an ordinary one, of a quiet or unproductive one, of a dormant one.
EVERY, QUIET_EVERY, DORMANT_EVERY = 22, 46, 164
#: The least rows after which a key without a productive one counts as unproductive.
UNPRODUCTIVE_AFTER = 10


def unproductive(rows: DataFrame, keys: list[str], productive: Column, least: int = UNPRODUCTIVE_AFTER) -> DataFrame:
    """(keys, n) of the keys with `least` rows or more, none of them productive."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.bool_or(productive).alias("any")).where((F.col("n") >= least) & ~F.col("any")).select(*keys, "n")


def lead_days(pairs: DataFrame, key: str, posted: str, takes_place: str) -> DataFrame:
    """(key, lead): days from the post to the day it announces, where it comes first."""
    return pairs.select(key, F.datediff(takes_place, posted).alias("lead")).where("lead >= 0")


def short_notice(leads: DataFrame, key: str, least: int = 3, below: float | None = 2.0) -> DataFrame:
    """(key, n, median_days) of the keys with `least` leads or more whose median is below a limit (None: all)."""
    out = leads.groupBy(key).agg(F.count("*").alias("n"), F.median("lead").alias("median_days")).where(F.col("n") >= least)
    return out if below is None else out.where(F.col("median_days") < below)


def missed_after_first(rows: DataFrame, key: str, at: str, missed: Column, hours: int = 12) -> DataFrame:
    """(key, n): a key's missed rows at least `hours` after its first row."""
    first = rows.groupBy(key).agg(F.min(at).alias("first_at"))
    late = rows.where(missed).join(first, key).where(F.col(at) >= F.col("first_at") + F.make_dt_interval(hours=F.lit(hours)))
    return late.groupBy(key).agg(F.count("*").alias("n"))


def busy(*parts: DataFrame) -> DataFrame:
    """The distinct rows of all parts."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.distinct()


def dominant(rows: DataFrame, keys: list[str], value: str, share: float = 0.8, least: int = 3) -> DataFrame:
    """(keys, value, n, total) of the values that make up `share` of a key's rows, of `least` rows at least."""
    counts = rows.groupBy(*keys, value).agg(F.count("*").alias("n"))
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("total")).where(F.col("total") >= least)
    return counts.join(totals, keys).where(F.col("n") >= share * F.col("total"))


def hours_overdue(last: Column, now: Column, dormant: Column, quiet: Column) -> Column:
    """Hours by which the next read is late; infinite for a key that was never read."""
    every = F.when(dormant, DORMANT_EVERY).when(quiet, QUIET_EVERY).otherwise(EVERY)
    hours = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(last.cast("timestamp"))) / 3_600_000_000
    return F.coalesce(hours - every, F.lit(float("inf")))


def due(keys: DataFrame, order: list[Column], runs_a_day: int = 3, spare: int = 5) -> DataFrame:
    """The first ceil(n / runs_a_day) + spare keys in that order: one run's share, and so a top-k."""
    n = keys.count()
    return keys.orderBy(*order).limit(-(-n // runs_a_day) + spare)


def read_depth(newer: Column, spare: int = 5, least: int = 10, most: int = 50) -> Column:
    """How many posts to fetch: the newer ones and some, within limits."""
    return F.least(F.greatest(newer + spare, F.lit(least)), F.lit(most))
