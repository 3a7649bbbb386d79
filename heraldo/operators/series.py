"""Streaks, rolling frames, gap islands and slot calendars over ordered rows.

`order` names columns that together order the rows of a key without ties. Streaks and latest versions are grouped
aggregates and equi-joins, so that a key with a third of all rows is pre-aggregated and split like any other; rolling
frames need a key's rows together and use a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_streak(rows: DataFrame, keys: list[str], order: list[str], happened: Column, applies: Column | None = None) -> DataFrame:
    """(keys, streak): how many of a key's latest rows, in a row, had it; rows it doesn't apply to are skipped."""
    rows = rows if applies is None else rows.where(applies)
    marked = rows.select(*keys, F.struct(*order).alias("at"), F.coalesce(happened, F.lit(False)).alias("yes"))
    broken = marked.groupBy(*keys).agg(F.max(F.when(~F.col("yes"), F.col("at"))).alias("broken"))
    after = marked.join(broken, keys).where(F.col("broken").isNull() | (F.col("at") > F.col("broken")))
    counted = after.groupBy(*keys).agg(F.count("*").alias("streak"))
    return broken.select(*keys).join(counted, keys, "left").select(*keys, F.coalesce("streak", F.lit(0).cast("long")).alias("streak"))


def level(streak: Column, warning: int = 3) -> Column:
    """A warning from `warning` times in a row on, a notice before, null for none."""
    return F.when(streak >= warning, "warning").when(streak >= 1, "notice")


def stuck(counts: DataFrame, keys: list[str], order: str, value: str, last: int = 4) -> DataFrame:
    """(keys, first_count, last_count) of keys whose `last` latest rows are all above zero and end no lower than they began."""
    newest = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    recent = counts.withColumn("place", F.row_number().over(newest)).where(F.col("place") <= last)
    ends = recent.groupBy(*keys).agg(F.max_by(value, "place").alias("first_count"), F.min_by(value, "place").alias("last_count"), F.min(value).alias("least"), F.count("*").alias("rows"))
    return ends.where((F.col("rows") == last) & (F.col("least") > 0) & (F.col("last_count") >= F.col("first_count"))).drop("least", "rows")


def rolling(rows: DataFrame, keys: list[str], order: list[str], size: int, **sums: Column) -> DataFrame:
    """rows with the sums over the latest `size` rows of their key and how many there are (`in_frame`)."""
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(size - 1), 0)
    return rows.withColumns({name: F.sum(x).over(frame) for name, x in sums.items()} | {"in_frame": F.count(F.lit(1)).over(frame)})


def rises(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """rows with `rise`, the change since the key's previous row."""
    return rows.withColumn("rise", F.col(value) - F.lag(value).over(Window.partitionBy(*keys).orderBy(*order)))


def cost_forecast(costs: DataFrame, keys: list[str], order: list[str], cost: str, last: int = 5, least: float = 1.0, default: float = 4.0) -> DataFrame:
    """costs with `forecast`: the largest of the `last` costs before, `least` at least, or `default` without any."""
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-last, -1)
    return costs.withColumn("forecast", F.when(F.max(cost).over(frame).isNotNull(), F.greatest(F.lit(least), F.max(cost).over(frame))).otherwise(default))


def gap_islands(rows: DataFrame, keys: list[str], at: str, order: list[str], gap_seconds: int) -> DataFrame:
    """(keys, island, first_at, last_at, n): runs of rows no two neighbours of which are more than the gap apart."""
    ordered = Window.partitionBy(*keys).orderBy(*order)
    apart = micros(F.col(at)) - micros(F.lag(at).over(ordered)) > gap_seconds * 1_000_000
    numbered = rows.withColumn("new", F.coalesce(apart.cast("int"), F.lit(0))).withColumn("island", F.sum("new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "island").agg(F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count("*").alias("n"))


def micros(at: Column) -> Column:
    return F.unix_micros(at.cast("timestamp"))


def sliding_budget(rows: DataFrame, keys: list[str], at: str, value: str, seconds: int, budget: float) -> DataFrame:
    """rows with `used`, the sum of the key's values less than `seconds` old, and `over`, what exceeds the budget."""
    frame = Window.partitionBy(*keys).orderBy(micros(F.col(at))).rangeBetween(-seconds * 1_000_000 + 1, 0)
    return rows.withColumn("used", F.sum(value).over(frame)).withColumn("over", F.greatest(F.lit(0.0), F.col("used") - budget))


def pacing(rows: DataFrame, keys: list[str], at: str, order: list[str], per_minute: float, margin: float = 0.5) -> DataFrame:
    """rows with `wait`, the seconds to let pass before a key's call so that its rate holds."""
    since = (micros(F.col(at)) - micros(F.lag(at).over(Window.partitionBy(*keys).orderBy(*order)))) / 1_000_000
    return rows.withColumn("wait", F.when(since.isNotNull(), F.greatest(F.lit(0.0), 60 / per_minute + margin - since)).otherwise(0.0))


#: The run slots of a day, as minutes from midnight, and how long after its slot a run still belongs to it.
SLOTS, SLOT_MINUTES = (180, 390, 1260), 180


def slot_of(at: Column, slots: tuple[int, ...] = SLOTS, minutes: int = SLOT_MINUTES) -> Column:
    """The slot whose window holds the moment, or null. Windows within a day don't overlap."""
    minute = F.hour(at) * 60 + F.minute(at)
    out = F.lit(None).cast("int")
    for slot in slots:
        out = F.when((minute >= slot) & (minute < slot + minutes), F.lit(slot)).otherwise(out)
    return out


def missed_slots(rows: DataFrame, key: str, at: str, days_running: int = 2) -> DataFrame:
    """(key, slot, day): slots without a row that were missed on the days before too, within the key's own first and last day."""
    seen = rows.select(key, F.to_date(at).alias("day"), slot_of(F.col(at)).alias("slot")).where("slot is not null").distinct()
    spans = rows.groupBy(key).agg(F.min(F.to_date(at)).alias("a"), F.max(F.to_date(at)).alias("b"))
    calendar = spans.select(key, F.explode(F.sequence("a", "b")).alias("day")).select(key, "day", F.explode(F.array(*map(F.lit, SLOTS))).alias("slot"))
    missed = calendar.join(seen, [key, "day", "slot"], "left_anti")
    before = F.lag("day", days_running - 1).over(Window.partitionBy(key, "slot").orderBy("day"))
    return missed.withColumn("before", before).where(F.datediff("day", "before") == days_running - 1).select(key, "slot", "day")


def next_slots(now: Column, days: int = 2) -> Column:
    """The slots after a moment, today and on the following days, in order: an array of timestamps."""
    minutes = F.array(*[F.lit(24 * 60 * d + s) for d in range(days) for s in SLOTS])
    starts = F.transform(minutes, lambda m: F.timestamp_micros(micros(F.date_trunc("day", now)) + m.cast("long") * 60_000_000))
    return F.filter(starts, lambda x: x > now)


def superseded(rows: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The rows that aren't the latest version of their key."""
    latest = rows.groupBy(*keys).agg(F.max(F.struct(*version)).alias("latest"))
    return rows.join(latest, keys).where(F.struct(*version) < F.col("latest")).drop("latest")


def image_ranges(rows: DataFrame, keys: list[str], order: list[str], count: str) -> DataFrame:
    """rows with [first_image, end_image): where each one's images lie when a key's images follow each other."""
    frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("end_image", F.sum(count).over(frame)).withColumn("first_image", F.col("end_image") - F.col(count))
