"""Answers that cover several posts of one request, given back to their posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Why a post of a request is read again alone.
STRAY, NONE, TWO, NO_EVENT, OTHER_IMAGE = "stray answer", "no answer", "two answers", "no event", "another post's image"


def split_answers(posts: DataFrame, answers: DataFrame) -> DataFrame:
    """(request, place, left_out, reason, events) of every post. posts: (request, place, images), places from 0 and how
    many images each has; answers: (request, post, is_event_post, reason, events), post being the letter of the place,
    events structs with image_index numbered through the request, null if none. `left_out` says why an answer isn't
    used; else it is null and the events' images are numbered within the post. An answer to no post of its request
    leaves all of the request out. Requests are short, so the running sum's window is too."""
    before = F.sum("images").over(Window.partitionBy("request").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    known = posts.select("request", "place", "images", F.coalesce(before, F.lit(0)).cast("int").alias("start"), F.char(F.col("place") + 65).alias("letter"))
    told = answers.withColumn("letter", F.trim(F.regexp_replace(F.upper(F.trim("post")), "^POST ", "")))
    stray = told.join(known, ["request", "letter"], "left_anti").select("request").distinct().withColumn("stray", F.lit(True))
    found = told.groupBy("request", "letter").agg(F.count("*").alias("n"), F.any_value(F.struct("is_event_post", "reason", "events")).alias("answer"))
    both = known.join(found, ["request", "letter"], "left").join(stray, "request", "left")
    events = F.col("answer.events")
    foreign = F.exists(events, lambda e: F.coalesce((e["image_index"] < F.col("start")) | (e["image_index"] >= F.col("start") + F.col("images")), F.lit(False)))
    empty = ~F.coalesce(F.col("answer.is_event_post"), F.lit(False)) | (F.coalesce(F.size(events), F.lit(0)) <= 0)
    why = F.when(F.col("stray"), STRAY).when(F.col("n").isNull(), NONE).when(F.col("n") > 1, TWO).when(empty, NO_EVENT).when(foreign, OTHER_IMAGE)
    own = F.transform(events, lambda e: e.withField("image_index", e["image_index"] - F.col("start")))
    used = both.withColumn("left_out", why)
    return used.select("request", "place", "left_out", F.when(F.col("left_out").isNull(), F.col("answer.reason")).alias("reason"), F.when(F.col("left_out").isNull(), own).alias("events"))
