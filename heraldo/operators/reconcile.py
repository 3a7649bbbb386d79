"""Readings and accounts held against what is known already: repeats in a batch, two ids of one post, misread names, totals."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from heraldo.operators.announcements import GATHERINGS, NIGHTS

CLOSE_SPELLING, RECHECK_AFTER_DAYS, GRAM = 0.88, 14, 3
BLOCK_DAYS, CROWDED = 64, 100_000


def repeats_earlier(readings: DataFrame, matched: DataFrame) -> DataFrame:
    """(batch, pos, id): unmatched readings on a day of an earlier post's of their batch, unless a night meets a gathering.

    readings: batch, pos (of the post, a whole number), id, event_type, days; matched: id. Days travel as bits of BLOCK_DAYS,
    and a window in the posts' order carries what days each kind has had. Batches of over CROWDED readings meet by day
    instead: only the earliest post per batch, day and kind matters there, so a day with many readings is one row.
    """
    many = F.size("days") > 1
    kind = F.when(F.col("event_type").isin(*GATHERINGS), 1).when(F.col("event_type").isin(*NIGHTS) & ~many, 2).otherwise(0)
    rows = readings.where("batch is not null and pos is not null").select("batch", "pos", "id", kind.alias("kind"), "days")
    # a row for CROWDED readings at most
    crowded = F.broadcast(readings.groupBy("batch").agg(F.count("*").alias("n")).where(F.col("n") > CROWDED).select("batch"))
    few, crowd = (rows.join(crowded, "batch", how) for how in ("left_anti", "left_semi"))

    place = lambda d: F.unix_date(d)
    block = lambda d: F.floor(place(d) / BLOCK_DAYS).cast("int")
    blocks = F.explode(F.array_distinct(F.transform(F.array_compact("days"), block)))
    bit = lambda bits, d: F.when(block(d) == F.col("block"), bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place(d), F.lit(BLOCK_DAYS))))).otherwise(bits)
    bits = few.select("*", blocks.alias("block")).select("batch", "pos", "id", "kind", "block", F.aggregate("days", F.lit(0).cast("long"), bit).alias("bits"))
    before = Window.partitionBy("batch", "block").orderBy("pos").rangeBetween(Window.unboundedPreceding, -1)
    had = [F.coalesce(F.bit_or(F.when(F.col("kind") == k, F.col("bits"))).over(before), F.lit(0).cast("long")) for k in range(3)]
    bits = bits.select("batch", "pos", "id", "kind", "bits", *[h.alias(f"had{k}") for k, h in enumerate(had)])
    fits = [F.when(F.col("kind") + k != 3, F.col(f"had{k}")).otherwise(F.lit(0).cast("long")) for k in range(3)]
    of_few = bits.where(F.col("bits").bitwiseAND(fits[0].bitwiseOR(fits[1]).bitwiseOR(fits[2])) != 0)

    on_day = crowd.select("batch", "pos", "id", "kind", F.explode("days").alias("day"))
    # without the hint Spark takes the days for as few as the rows they come from, and sends them to every executor
    first = on_day.groupBy("batch", "day", F.col("kind").alias("other")).agg(F.min("pos").alias("first")).hint("merge")
    of_crowd = on_day.join(first, ["batch", "day"]).where((F.col("first") < F.col("pos")) & (F.col("kind") + F.col("other") != 3))
    met = of_few.select("batch", "pos", "id").unionByName(of_crowd.select("batch", "pos", "id"))
    return met.join(matched.select("id"), "id", "left_anti").select("batch", "pos", "id").distinct()


def one_identity(posts: DataFrame, post_id: str, code: str, made: str) -> DataFrame:
    """(old, new): ids to rewrite where one link's code has several; an id of the service wins over one that starts with `made`."""
    own = F.col(post_id)
    best = posts.where(F.col(code).isNotNull()).groupBy(code).agg(F.coalesce(F.min(F.when(~own.startswith(made), own)), F.min(own)).alias("new"))
    return posts.join(best, code).where(own != F.col("new")).select(own.alias("old"), "new").distinct()


@F.pandas_udf(DoubleType())
def spelling(a: pd.Series, b: pd.Series) -> pd.Series:
    """How much of two spellings agrees, from 0 to 1."""
    return pd.Series([difflib.SequenceMatcher(None, y, x).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def known_account(read: DataFrame, accounts: DataFrame) -> DataFrame:
    """(name, cut, account): the account a name read in an image stands for; names without one have no row.

    read: name, cut; accounts: account. A name cut off stands for the only account that begins with it, another for the
    closest spelling of CLOSE_SPELLING or more, the last in order among equals. Spellings that close share GRAM letters
    in a row, but for one of four letters and one of five: names under six letters also meet by a letter.
    """
    known = accounts.select(F.lower("account").alias("account")).distinct()
    names = read.where("name is not null").select("name", "cut").distinct()
    heads = known.select("account", F.explode(F.sequence(F.lit(1), F.length("account"))).alias("n")).select("account", F.substring(F.col("account"), F.lit(1), F.col("n")).alias("name"))
    begun = names.where("cut").join(heads, "name").groupBy("name", "cut").agg(F.count("*").alias("c"), F.min("account").alias("account")).where("c = 1").drop("c")
    # at this ratio the names' lengths differ by a quarter at most
    grams = lambda c: F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - (GRAM - 1), F.lit(1))), lambda i: F.substring(c, i, F.lit(GRAM)))
    letters = lambda c: F.split(c, "")
    blocks = lambda c: F.explode(F.array_distinct(F.when(F.length(c) < 6, F.concat(grams(c), letters(c))).otherwise(grams(c))))
    pairs = names.where("not cut").select("name", "cut", blocks(F.col("name")).alias("block")).join(known.select("account", blocks(F.col("account")).alias("block")), "block")
    alike = pairs.where(F.abs(F.length("name") - F.length("account")) * 4 <= F.greatest(F.length("name"), F.length("account"))).select("name", "cut", "account").distinct()
    close = alike.withColumn("ratio", spelling("name", "account")).where(F.col("ratio") >= CLOSE_SPELLING)
    return begun.unionByName(close.groupBy("name", "cut").agg(F.max(F.struct("ratio", "account")).alias("best")).select("name", "cut", F.col("best.account").alias("account")))


def requests_used(entries: DataFrame, batch: Column, alone: Column) -> DataFrame:
    """(used, shared, single): requests that entries of a cache took; a batch of several posts is one request."""
    several = F.size(batch) > 1
    counts = entries.agg(F.countDistinct(F.when(several, batch)).alias("shared"), F.count_if(F.coalesce(alone, F.lit(False)) | (F.size(batch) == 1)).alias("single"))
    return counts.select((F.col("shared") + F.col("single")).alias("used"), "shared", "single")


def discovery_totals(accounts: DataFrame) -> DataFrame:
    """(checked, personal, business, no_hint, pending) of accounts with status, hint and kind."""
    business = F.col("status") == "business"
    return accounts.agg(
        F.count("*").alias("checked"), F.count_if(F.col("status") == "personal").alias("personal"), F.count_if(business).alias("business"),
        F.count_if(business & (F.col("hint") == 0)).alias("no_hint"), F.count_if(business & (F.col("hint") > 0) & F.col("kind").isNull()).alias("pending"),
    )


def recheck_due(accounts: DataFrame, today: Column, after: int = RECHECK_AFTER_DAYS) -> DataFrame:
    """Personal accounts that weren't checked for `after` days, the likeliest first, then by position."""
    due = (F.col("status") == "personal") & (F.col("checked_on").isNull() | (F.col("checked_on") <= F.date_sub(today, after)))
    return accounts.where(due).orderBy(F.col("hint").desc(), "position")


def discovery_order(accounts: DataFrame) -> DataFrame:
    """Accounts by city (yes, unknown, no), those that announce events first, then the most followed."""
    place = F.when(F.col("in_city") == "yes", 0).when(F.col("in_city") == "unknown", 1).otherwise(2)
    return accounts.orderBy(place, ~F.col("announces"), F.coalesce("followers", F.lit(0)).desc(), "position")
