"""Which rows go on: by age, by what became of them, by days and styles, by quiet hours; and in which order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOOKBACK_DAYS, FIRST_READ_DAYS, MOST_LOOKBACK_DAYS = 7, 30, 30
QUIET_BEFORE, QUIET_AFTER = 60, 45  # minutes around a slot
HELD = 12
MEDIA_ORDER = {"VIDEO": 1, "STORY": 2}


def within_lookback(published: Column, now: Column, first_read: Column, days: int = LOOKBACK_DAYS) -> Column:
    """Published in the last days: `days`, or more for an account that was never read."""
    span = F.when(first_read, FIRST_READ_DAYS).otherwise(min(days, MOST_LOOKBACK_DAYS))
    return published >= now - F.make_dt_interval(days=span)


def last_day(date: Column, end_date: Column, sessions: Column | None = None) -> Column:
    """An event's last day: its last session's, its end, or its only day."""
    of_series = F.lit(None).cast("date") if sessions is None else F.array_max(F.transform(sessions, lambda s: s["date"]))
    return F.coalesce(end_date, of_series, date)


def has_ended(last: Column, today: Column) -> Column:
    return F.coalesce(last < today, F.lit(False))


def is_upcoming(last: Column, today: Column) -> Column:
    return F.coalesce(last >= today, F.lit(False))


def had_events(outcome: Column, is_event_post: Column) -> Column:
    """Whether a post became or joined events; where no outcome was kept, whether it was read as announcing some."""
    return F.when(outcome.isNull(), F.coalesce(is_event_post, F.lit(False))).otherwise(outcome.isin("event", "merged"))


def is_broken(attempted: Column, failed: Column, limited: Column) -> Column:
    """Whether a run read nothing, and not for being rate-limited."""
    return (attempted > 0) & (failed == attempted) & ~limited


def takes_place(days: Column, styles: Column, first: Column, last: Column, wanted: list[str]) -> Column:
    """Whether an event has a day in a range and, if any are wanted, a style that begins with a wanted one."""
    styled = F.exists(styles, lambda s: F.exists(F.array(*map(F.lit, wanted)), lambda w: F.startswith(s, w))) if wanted else F.lit(True)
    return F.exists(days, lambda d: d.between(first, last)) & styled


def near_slot(moment: Column, slots: list[str], before: int = QUIET_BEFORE, after: int = QUIET_AFTER) -> Column:
    """Whether a moment lies within so many minutes of a daily slot (HH:MM), also across midnight."""
    minute = F.hour(moment) * 60 + F.minute(moment)

    def near(slot: str) -> Column:
        at = int(slot[:2]) * 60 + int(slot[3:])
        return F.pmod(minute - (at - before), F.lit(24 * 60)) < before + after

    out = F.lit(False)
    for slot in slots:
        out = out | near(slot)
    return out


def publishable(events: DataFrame, post: str, reasons: str) -> tuple[DataFrame, DataFrame]:
    """The events without reasons against them, and for each post that lost some the set of reasons."""
    lost = events.where(F.size(reasons) > 0).select(post, F.explode(reasons).alias("reason")).distinct()
    return events.where(F.size(reasons) == 0), lost.groupBy(post).agg(F.array_sort(F.collect_list("reason")).alias("reasons"))


def refused_links(linked: DataFrame) -> DataFrame:
    """Of pairs (days_a, days_b) that a post linked by hand those that share no day: a doubt, and no match."""
    return linked.where(~F.coalesce(F.arrays_overlap("days_a", "days_b"), F.lit(False)))


def carried_over(before: DataFrame, now: DataFrame, followed: DataFrame, key: str) -> DataFrame:
    """Keys that failed before, weren't tried now and are still followed."""
    return before.select(key).distinct().join(now.select(key), key, "left_anti").join(followed.select(key), key, "left_semi")


def latest_try(runs: DataFrame, key: str, finished: str) -> DataFrame:
    """Each key's last run that tried it, as a grouped maximum."""
    rest = [c for c in runs.columns if c != key]
    return runs.groupBy(key).agg(F.max_by(F.struct(*rest), finished).alias("r")).select(key, "r.*")


def ordered_media(media: Column) -> Column:
    """Images first, then videos, then stories; in each the newest first."""
    rank = lambda m: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in MEDIA_ORDER.items() for x in p]), m["media_type"]), F.lit(0))
    before = lambda a, b: F.when(rank(a) != rank(b), rank(a) - rank(b)).when(a["published"] > b["published"], -1).when(a["published"] < b["published"], 1).otherwise(0)
    return F.array_sort(media, before)


def second_opinions(items: DataFrame, records: DataFrame, account: str, published: str, key: str, had: Column, least: int, most: int = HELD) -> DataFrame:
    """The first `most` items: of accounts with an event on record, then others, then unproductive ones; newest first."""
    seen = records.groupBy(account).agg(F.bool_or(had).alias("productive"), F.count("*").alias("n"))
    tier = F.when(F.col("productive"), 0).when(F.col("n") >= least, 2).otherwise(1)
    return items.join(seen, account, "left").select(*items.columns, tier.alias("tier")).orderBy("tier", F.col(published).desc(), key).limit(most)


def first_published(links: DataFrame, posts: DataFrame, event: str) -> DataFrame:
    """(event, first): the earliest record that names the event, else its earliest post."""
    a, b = links.groupBy(event).agg(F.min("processed_at").alias("a")), posts.groupBy(event).agg(F.min("published").alias("b"))
    return a.join(b, event, "full").select(event, F.coalesce("a", "b").alias("first"))
