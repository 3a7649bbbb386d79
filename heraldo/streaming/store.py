"""Readings of posts stored in micro-batches: events and the posts' records are two tables that change together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heraldo.functions import text
from heraldo.operators import rereads

EVENTS = "id string, account string, date date, title string, start_time string, event_type string, posts array<string>, confidence string, doubts array<string>, gone boolean"
RECORDS = "post string, account string, outcome string, detail string, event_ids array<string>, provisional boolean, gone boolean"

# The doubt and the detail of what was called off.
CANCEL_FLAG = "lo anunció cancelado o aplazado: revisar"
CANCELLED = "cancelado"
FOUND = ["date", "title", "start_time", "event_type"]


def changes(events: DataFrame, records: DataFrame, batch: DataFrame, number: int) -> tuple[DataFrame, DataFrame]:
    """(events, records) that a batch of readings changes, each row whole, with `gone` where it is taken away.

    batch: post, account, at, is_event_post, cancels, provisional, readings (array of FOUND: what may be published), refused
    (array of reasons). Of a post's readings in one batch the newest counts. A post first leaves the events it announced;
    those that nobody else announced give their ids back. Each reading joins its account's event of the same day, title and
    start, or the first such reading of the batch, else it keeps an id that it had (rereads) or is new. Last, a post that
    announced events, has none now and says they're called off takes down those of its own account, also from other posts'
    records; events of other accounts stay with low confidence and a doubt, which they keep when they are read again.
    """
    said = F.struct(*[c for c in batch.columns if c != "post"])
    latest = batch.where("post is not null").groupBy("post").agg(F.max_by(said, F.struct("at", F.xxhash64(said))).alias("r")).select("post", "r.*")
    named = events.select("id", F.explode(F.array_distinct("posts")).alias("post"))
    had = named.join(latest.select("post"), "post")
    left = events.join(had.groupBy("id").agg(F.collect_set("post").alias("_left")), "id", "left").withColumn("_posts", F.when(F.col("_left").isNull(), F.col("posts")).otherwise(F.array_except("posts", "_left")))

    key = ["account", "date", "_title", "_start"]
    keyed = lambda rows: rows.withColumn("_title", F.coalesce(text.fold(F.col("title")), F.lit(""))).withColumn("_start", F.coalesce("start_time", F.lit("")))
    readings = keyed(latest.select("post", "account", F.posexplode("readings").alias("pos", "e")).select("post", "account", "pos", "e.*"))
    standing = keyed(left.where(F.size("_posts") > 0)).groupBy(*key).agg(F.min("id").alias("_there"))
    readings = readings.join(standing, key, "left")
    first = readings.where("_there is null").groupBy(*key).agg(F.min(F.struct("post", "pos")).alias("_first"))
    readings = readings.join(first, key, "left").withColumn("_found", F.col("_first") == F.struct("post", "pos"))
    founders = readings.where("_found")
    alone = left.where((F.size("_posts") == 0) & (F.size(F.array_distinct("posts")) == 1)).withColumn("post", F.element_at("posts", 1)).withColumn("pos", F.col("id"))
    kept = rereads.kept_ids(founders, alone, "post", "pos", "id").withColumnRenamed("id", "_kept")
    new_id = F.concat_ws("-", text.slug(F.col("title")), F.col("date").cast("string"), F.substring(F.sha2(F.concat_ws("|", F.lit(number), "pos", "post"), 256), 1, 12))
    ids = founders.join(kept, ["post", "pos"], "left").select(*key, F.coalesce("_kept", new_id).alias("_new"))
    added = readings.join(ids, key, "left").withColumn("id", F.coalesce("_there", "_new")).withColumn("_found", F.coalesce("_found", F.lit(False)))
    joined = added.groupBy("id").agg(F.sort_array(F.collect_set("post")).alias("_added"), F.max_by(F.struct("account", *FOUND), F.col("_found").cast("int")).alias("_new"))

    announced = had.select("post").distinct().withColumn("_announced", F.lit(True))
    off = latest.where(F.coalesce("cancels", F.lit(False)) & (F.coalesce(F.size("readings"), F.lit(0)) <= 0)).join(announced, "post", "left_semi")
    called = had.join(off.select("post", F.col("account").alias("_by")), "post").groupBy("id").agg(F.sort_array(F.collect_set("_by")).alias("_by"))

    whole = left.join(joined, "id", "full").join(called, "id", "left").where(F.col("_left").isNotNull() | F.col("_added").isNotNull())
    posts = F.array_union(F.coalesce("_posts", F.array().cast("array<string>")), F.coalesce("_added", F.array().cast("array<string>")))
    stays = F.coalesce(F.size("_posts") > 0, F.lit(False))
    of = lambda c: F.when(stays | F.col("_new").isNull(), F.col(c)).otherwise(F.col("_new")[c])
    flags = F.transform(F.coalesce("_by", F.array().cast("array<string>")), lambda a: F.concat(F.lit("@"), a, F.lit(f" {CANCEL_FLAG}")))
    old = F.coalesce("doubts", F.array().cast("array<string>"))
    doubts = F.array_union(F.when(stays, old).otherwise(F.filter(old, lambda d: d.endswith(CANCEL_FLAG))), flags)
    low = F.exists(doubts, lambda d: d.endswith(CANCEL_FLAG))
    gone = (F.size(posts) == 0) | (stays & F.coalesce(F.array_contains("_by", F.col("account")), F.lit(False)))
    changed = whole.select(
        "id", of("account").alias("account"), *[of(c).alias(c) for c in FOUND], posts.alias("posts"), F.when(low, "low").when(stays, F.col("confidence")).alias("confidence"), doubts.alias("doubts"), gone.alias("gone")
    )

    taken = changed.where("gone").select("id").join(called, "id", "left_semi")
    result = added.join(taken.select("id", F.lit(True).alias("_off")), "id", "left").where("_off is null").groupBy("post").agg(
        F.transform(F.sort_array(F.collect_set(F.struct("pos", "id"))), lambda x: x["id"]).alias("ids"), F.bool_or("_found").alias("own"))
    reasons = F.array_join(F.sort_array(F.array_distinct("refused")), ", ")
    cancelled = F.col("_off").isNotNull()
    refused = F.coalesce(F.col("is_event_post") & (F.size("refused") > 0), F.lit(False))
    outcome = F.when(F.col("own"), "event").when(F.col("ids").isNotNull(), "merged").when(cancelled | (F.size("readings") > 0) | refused, "discarded").otherwise("not_event")
    detail = F.when(F.col("ids").isNotNull(), None).when(cancelled | (F.size("readings") > 0), CANCELLED).when(refused, reasons)
    none = F.array().cast("array<string>")
    own = latest.join(result, "post", "left").join(off.select("post", F.lit(True).alias("_off")), "post", "left").select(
        "post", "account", outcome.alias("outcome"), detail.alias("detail"), F.array_distinct(F.coalesce("ids", none)).alias("event_ids"), "provisional", F.lit(False).alias("gone")
    )
    lost = records.select("post", F.explode("event_ids").alias("id")).join(taken, "id", "left_semi").groupBy("post").agg(F.collect_set("id").alias("_lost"))
    rest = F.array_except("event_ids", "_lost")
    bare = F.size(rest) == 0
    others = records.join(latest, "post", "left_anti").join(lost, "post").select(
        "post", "account", F.when(bare, "discarded").otherwise(F.col("outcome")).alias("outcome"), F.when(bare, CANCELLED).otherwise(F.col("detail")).alias("detail"), rest.alias("event_ids"),
        (F.col("provisional") & ~bare).alias("provisional"), F.lit(False).alias("gone"))
    return changed, own.unionByName(others)


def table(spark: SparkSession, path: str, name: str, key: str, number: int, every: int) -> DataFrame:
    """The rows of `events` or `records` as batch `number` left them: each key's newest since the last batch written whole."""
    schema = EVENTS if name == "events" else RECORDS
    if number < 0:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, batch long").option("basePath", f"{path}/{name}").parquet(*[f"{path}/{name}/batch={n}" for n in range(number - number % every, number + 1)])
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), "batch").alias("r")).select(key, "r.*")
    return newest.where(~F.col("gone")).drop("batch")


def take(batch: DataFrame, number: int, path: str, every: int = 20) -> None:
    """Stores one batch: its changed events, then its changed records, whose folder makes the batch count. It reads what the batch before
    left, so one that is repeated after a failure at any point writes the same again. Each `every`-th batch writes whole tables."""
    spark = batch.sparkSession
    events, records = (table(spark, path, name, key, number - 1, every) for name, key in (("events", "id"), ("records", "post")))
    changed = changes(events, records, batch, number)
    for name, key, old, new in (("events", "id", events, changed[0]), ("records", "post", records, changed[1])):
        if number % every == 0:
            new = new.where(~F.col("gone")).unionByName(old.join(new, key, "left_anti"))
        new.write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")


def store(stream: DataFrame, path: str, every: int = 20):
    """A query that stores a stream of readings under path, a folder that all executors share."""
    return stream.writeStream.foreachBatch(lambda batch, number: take(batch, number, path, every)).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()


def last_batch(spark: SparkSession, path: str) -> int:
    """The last batch whose records are whole; -1 before the first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/records/batch=*/_SUCCESS")
    found = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(folder) or []
    return max((int(f.getPath().getParent().getName().removeprefix("batch=")) for f in found), default=-1)
