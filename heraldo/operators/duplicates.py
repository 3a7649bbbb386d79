"""Stored events that the rules say are one, merged in input order, and the references to those that went.

An event meets those kept so far, in the order they came; the first it matches absorbs it, or is absorbed by it if it says
less, and takes the first one's place. So the outcome depends on the order and on what was absorbed before. Two events can
only match on a shared day, so each account's events are folded apart for each chain of days that its spans link.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heraldo.functions import dates
from heraldo.operators import announcements, merging

#: Of `prepared`, what a title tells: it stays with the event that is kept. Its venue's key goes with the venue.
TITLED = ("t", "w", "kinds", "v")


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), computed once however often `use` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def day_chains(spans: DataFrame, group: str, first: str, last: str) -> DataFrame:
    """spans with `chain`: the first day of the run of days, linked by the group's spans, that a span lies in; null without days.

    A span links each of its days to the day before. The window runs over a group's distinct days, not over its rows.
    """
    covered = spans.select(group, F.explode(F.sequence(first, last)).alias("day"), F.col(first).alias("first_day")).groupBy(group, "day").agg(F.bool_and(F.col("day") == F.col("first_day")).alias("starts"))
    chained = covered.withColumn("chain", F.max(F.when(F.col("starts"), F.col("day"))).over(Window.partitionBy(group).orderBy("day"))).select(group, F.col("day").alias(first), "chain")
    return spans.join(chained, [group, first], "left")


def merge_duplicates(events: DataFrame, fields: list[str]) -> DataFrame:
    """The events left, with `dropped`: the ids of those merged into each, in the order they were.

    events: id, pos (input order, unique), account, posts (array of ids), seen (when its newest post was published) and
    `fields`, which must hold title, event_type, venue, start_time, date, end_date (days) and sessions. Events that share a
    post stay apart. The event with more fields filled is kept, then the one with the longer title, then the earlier; it
    absorbs the other as one more post of it, seen when the other's newest was. Empty texts and arrays count as missing;
    an event without a day or an account matches none. One account's chain of days is folded in one row.
    """
    kept = ["date", "end_date", "sessions", *[f for f in fields if f not in ("date", "end_date", "sessions")]]
    arrays = [f for f in kept if events.schema[f].dataType.typeName() == "array"]
    texts = [f for f in kept if events.schema[f].dataType.typeName() == "string"]
    clean = events.withColumns({f: F.when(F.size(f) > 0, F.col(f)) for f in arrays} | {f: F.nullif(f, F.lit("")) for f in texts})
    clean = clean.withColumn("posts", F.array_compact(F.coalesce("posts", F.array().cast("array<string>"))))
    # what prepared() looks at besides; it matters across accounts only
    more = [c for c in ("organizer", "contact") if c not in kept]
    told = announcements.prepared(clean.withColumns({c: F.lit(None).cast("string") for c in more}), "e").drop(*[f"e_{c}" for c in more])
    told = told.select(*[F.col(c).alias(c.removeprefix("e_")) for c in told.columns])
    spanned = day_chains(told.withColumns({"from": F.array_min("days"), "to": F.array_max("days")}), "account", "from", "to")

    def whole(base: dict[str, Column], values: dict[str, Column]) -> Column:
        series = F.coalesce(F.size(values["sessions"]) > 0, F.lit(False))
        filled = sum((F.when(values[f].isNotNull(), 1).otherwise(0) for f in kept), F.lit(0))
        now = base | values | {"series": series, "multi": values["end_date"].isNotNull() | series, "days": dates.days_of(values["date"], values["end_date"], values["sessions"])}
        now["rich"] = F.struct(filled.alias("filled"), F.coalesce(F.length(values["title"]), F.lit(0)).alias("length"))
        return F.struct(*[v.alias(k) for k, v in now.items()])

    carried = ["pos", "id", "account", "seen", "posts", *TITLED]
    none = F.array().cast(f"array<{events.schema['id'].dataType.simpleString()}>")
    each = whole({c: F.col(c) for c in carried} | {"dropped": none}, {f: F.col(f) for f in kept})
    # events that can't match any other needn't be brought together
    alone = F.when(F.col("chain").isNull(), F.col("pos"))
    log = spanned.select("account", "chain", alone.alias("alone"), each.alias("e")).groupBy("account", "chain", "alone").agg(F.array_sort(F.collect_list("e")).alias("log"))
    kind = log.schema["log"].dataType.simpleString()

    def joined(keep: Column, drop: Column) -> Column:
        values = merging.absorbed(keep, drop, kept)
        base = {c: keep[c] for c in carried} | {
            "seen": F.greatest(keep["seen"], drop["seen"]), "posts": F.array_union(keep["posts"], drop["posts"]), "v": F.when(keep["v"] == "", drop["v"]).otherwise(keep["v"]),
            "dropped": F.concat(keep["dropped"], F.array(drop["id"]), drop["dropped"]),
        }
        return _with(F.struct(*[values[f].alias(f) for f in kept]), lambda x: whole(base, {f: x[f] for f in kept}))

    def one_of(k: Column, e: Column) -> Column:
        fuller = k["rich"] >= e["rich"]
        pair = F.struct(F.when(fuller, k).otherwise(e).alias("keep"), F.when(fuller, e).otherwise(k).alias("drop"))
        return _with(pair, lambda x: joined(x["keep"], x["drop"]))

    def step(done: Column, e: Column) -> Column:
        meets = lambda k: F.arrays_overlap(k["days"], e["days"]) & ~F.arrays_overlap(k["posts"], e["posts"])
        matches = F.transform(done, lambda k: F.coalesce(meets(k) & announcements.same_event(k, e), F.lit(False)))
        place = lambda at: F.when(at == 0, F.concat(done, F.array(e))).otherwise(F.transform(done, lambda k, i: F.when(i + 1 == at, one_of(k, e)).otherwise(k)))
        return _with(F.array_position(matches, F.lit(True)), place).cast(kind)

    folded = log.select(F.explode(F.aggregate(F.slice("log", 2, F.size("log")), F.slice("log", 1, 1).cast(kind), step)).alias("e"))
    return folded.select("e.id", "e.account", "e.pos", "e.posts", "e.seen", *[F.col("e")[f].alias(f) for f in kept], "e.dropped")


def renamed(merged: DataFrame) -> DataFrame:
    """(dropped, kept): where each event that went is now, however often it was passed on."""
    return merged.select(F.explode("dropped").alias("dropped"), F.col("id").alias("kept"))


def rewritten(records: DataFrame, renamed: DataFrame, key: str, ids: str) -> DataFrame:
    """records with their array of event ids naming the events that are kept, each once, in order. `key` is unique."""
    each = records.select(key, F.posexplode(ids).alias("at", "dropped")).join(renamed, "dropped", "left")
    now = each.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("kept", "dropped").alias("id")))).alias("now"))
    return records.join(now, key, "left").withColumn(ids, F.coalesce(F.array_distinct(F.transform("now", lambda x: x["id"])), F.col(ids))).select(*records.columns)
