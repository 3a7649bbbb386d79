"""A post read again: each of its readings takes the id of an event that it announced before, one to one, so that events keep their links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heraldo.functions import text

FIELDS = ["date", "title", "start_time", "event_type"]


def fit(event: Column, reading: Column) -> Column:
    """How well an event fits a reading, 0 to 15: the same date weighs most, then title, start and type. Dates and types
    that both lack are the same, starts that both lack aren't."""
    same_start = (event["start_time"] != "") & (event["start_time"] == reading["start_time"])
    same = [F.equal_null(event["date"], reading["date"]), event["_title"] == reading["_title"], same_start, F.equal_null(event["event_type"], reading["event_type"])]
    return sum((F.coalesce(s.cast("int"), F.lit(0)) * w for s, w in zip(same, (8, 4, 2, 1))), F.lit(0))


def kept_ids(readings: DataFrame, events: DataFrame, post: str, pos: str, event_id: str) -> DataFrame:
    """(post, pos, id) of every reading; id is null where the post has no event left for it, so that it needs a new one.

    readings: post, pos (their order in the post) and FIELDS. events: post, pos (the order they're stored in), id and FIELDS,
    of events that only this post announced. Readings that lie closest to any event choose first, equal ones by pos; each takes
    the event left that fits it best, the first of equal ones, even if nothing agrees. Readings of a null post get none.

    A post's readings and events are each gathered in one array, as a choice depends on those before it: they grow with
    what one post announces, and not with the number of posts.
    """
    folded = F.coalesce(text.fold(F.col("title")), F.lit("")).alias("_title")
    said = F.struct(F.col(pos).alias("pos"), "date", folded, "start_time", "event_type")
    read = readings.groupBy(post).agg(F.collect_list(said).alias("_read"))
    had = events.groupBy(post).agg(F.sort_array(F.collect_list(F.struct(F.col(pos).alias("pos"), F.col(event_id).alias("id"), "date", folded, "start_time", "event_type"))).alias("_had"))
    both = read.join(had, post, "left")
    empty = F.filter("_had", lambda e: F.lit(False))
    closest = lambda r: F.coalesce(F.array_max(F.transform("_had", lambda e: fit(e, r))), F.lit(0))
    queue = F.sort_array(F.transform("_read", lambda r: F.struct((-closest(r)).alias("o"), r["pos"].alias("pos"), r.alias("r"))))
    both = both.withColumn("_had", F.coalesce("_had", F.array().cast(both.schema["_had"].dataType))).withColumn("_queue", queue)
    kind = events.schema[event_id].dataType
    none = F.array().cast(f"array<struct<pos:{readings.schema[pos].dataType.simpleString()},id:{kind.simpleString()}>>")

    def choose(state: Column, x: Column) -> Column:
        left = state["left"]
        best = F.array_max(F.transform(left, lambda e, i: F.struct(fit(e, x["r"]).alias("f"), (-i).alias("i"))))
        taken = F.get(left, -best["i"])
        rest = F.filter(left, lambda e, i: F.coalesce(i != -best["i"], F.lit(True)))
        return F.struct(rest.alias("left"), F.concat(state["given"], F.array(F.struct(x["pos"].alias("pos"), taken["id"].alias("id")))).alias("given"))

    given = F.aggregate("_queue", F.struct(F.concat(F.col("_had"), empty).alias("left"), none.alias("given")), choose)["given"]
    return both.select(post, F.explode(given).alias("g")).select(post, F.col("g.pos").alias(pos), F.col("g.id").alias(event_id))
