"""Why a post's event is shown or not: what is known of the post on one row, and the first rung of a ladder that holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heraldo.functions import text
from heraldo.operators import filters

# How a record's reason begins when somebody took its event away, and what is said of one with no detail.
REMOVED_BY_HAND = "Quitado a mano"
NO_DETAIL = "no era publicable"

#: Verdicts after which adding the post by hand reads it again.
ADD = ["gone", "discarded", "hidden", "rejected", "not_event", "not_followed", "not_looked_up", "new_account", "after_last_read", "before_first_read", "too_old", "last_read_failed", "waiting", "unexplained"]


def recorded(records: DataFrame, events: DataFrame, today: Column) -> DataFrame:
    """(code, record, n_stored, shown): of each post code its earliest record, how many events it has become that are still
    stored, and those not over by last day and id. A record without ids that became events has those that name its link."""
    r = F.struct("account", "permalink", "outcome", "detail", "reason", "model", "provisional", "processed_at", "event_ids", "is_event_post")
    first = records.withColumn("code", text.post_code(F.col("permalink"))).where("code is not null").groupBy("code").agg(F.min_by(r, F.struct("processed_at", "permalink", F.xxhash64(r))).alias("record"))
    outcome = F.coalesce("record.outcome", F.when(F.col("record.is_event_post"), "event").otherwise("not_event"))
    first = first.withColumn("record", F.col("record").withField("outcome", outcome))
    became = first.where(F.col("record.outcome").isin("event", "merged"))
    listed = F.coalesce(F.size("record.event_ids"), F.lit(0)) > 0
    by_id = became.where(listed).select("code", F.explode(F.col("record.event_ids").cast("array<string>")).alias("id"))
    events = events.withColumn("id", F.col("id").cast("string"))
    of_link = events.select("id", F.explode("permalinks").alias("permalink"))
    by_link = became.where(~listed & (F.col("record.outcome") == "event")).select("code", F.col("record.permalink").alias("permalink")).join(of_link, "permalink").select("code", "id")
    is_shown = filters.is_upcoming(F.col("last_day"), today)
    stored = by_id.unionByName(by_link).distinct().join(events.select("id", "title", "last_day"), "id").groupBy("code").agg(
        F.count("*").alias("n_stored"), F.array_sort(F.collect_list(F.when(is_shown, F.struct("last_day", "id", "title")))).alias("shown")
    )
    return first.join(stored, "code", "left")


def account_facts(followed: DataFrame, feeds: DataFrame, states: DataFrame, tries: DataFrame) -> DataFrame:
    """What is known of each account on one row, as grouped maxima over all four tables at once, which combine before the shuffle."""
    yes = F.lit(True)
    parts = [
        followed.select("account", yes.alias("_followed")), feeds.select("account", yes.alias("_looked"), F.col("problem").alias("_problem")),
        states.select("account", F.col("first_seen").alias("_first"), F.col("last_read").alias("_read")), tries.select("account", F.struct("finished_at", "failed").alias("_tried")),
    ]
    rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    return rows.groupBy("account").agg(*[F.max(c).alias(c) for c in rows.columns if c != "account"])


def diagnose(
    asked: DataFrame, records: DataFrame, events: DataFrame, followed: DataFrame, feeds: DataFrame, feed: DataFrame, states: DataFrame, runs: DataFrame, tries: DataFrame, now: Column,
    today: Column, zone: str = "America/Bogota", lookback: int = filters.LOOKBACK_DAYS, first_days: int = filters.FIRST_READ_DAYS,
) -> DataFrame:
    """asked with code, of_account, verdict, add (whether adding it by hand helps), checks (mark, check), details and shown events.

    asked: link, account, author (what its page says, if read). feeds: accounts looked up (account, problem: null, private or
    another); feed: their latest posts (account, permalink, published). states: account, first_seen, last_read. runs:
    finished_at, pending. tries: what each run tried (account, finished_at, failed). A post with a record is explained by it. Any other is explained by
    its account and its date: that account's last reading, which goes before the last run's, the reach of a first and of a
    usual reading, the last run that tried the account, what the last run left waiting.

    All tables meet by equi-joins on codes, ids and accounts; only the last run, one row, goes to every row.
    """
    link_account = F.lower(F.nullif(F.regexp_extract("link", r"^\s*(?:https?://)?[^/\s]+/([A-Za-z0-9._]+)/(?:p|reels?|tv)/", 1), F.lit("")))
    # rows without a code or an account match nothing: their keys, which no code or name can be, spread them
    spread = F.concat(F.lit("/"), F.pmod(F.monotonically_increasing_id(), F.lit(10007)).cast("string"))
    q = asked.withColumn("code", text.post_code(F.col("link"))).withColumn("_spread", spread).withColumn("_code", F.coalesce("code", "_spread"))
    q = q.join(recorded(records, events, today).withColumnRenamed("code", "_code"), "_code", "left")
    named = F.coalesce("account", link_account, "author")
    q = q.withColumn("_with", F.when(F.col("record").isNull() & (F.col("author") != named), named)).withColumn("of_account", F.coalesce("record.account", F.when(named.isNotNull(), F.coalesce("author", named))))
    q = q.withColumn("_account", F.coalesce("of_account", "_spread"))
    posts = feed.withColumn("_code", text.post_code(F.col("permalink"))).groupBy(F.col("account").alias("_account"), "_code").agg(F.max("published").alias("published"))
    q = q.join(posts, ["_account", "_code"], "left").join(account_facts(followed, feeds, states, tries).withColumnRenamed("account", "_account"), "_account", "left")
    last = runs.agg(F.max_by(F.struct("finished_at", "pending"), F.struct("finished_at", "pending")).alias("_last")).withColumn("_one", F.lit(1))
    q = q.withColumn("_one", F.lit(1)).join(F.broadcast(last), "_one", "left")

    yes = lambda c: F.coalesce(c, F.lit(False))
    r, published, shown, followed_now = F.col("record"), F.col("published"), F.coalesce(F.size("shown"), F.lit(0)), yes(F.col("_followed"))
    first_day = F.make_timestamp(F.year("_first"), F.month("_first"), F.day("_first"), F.lit(0), F.lit(0), F.lit(0), F.lit(zone))
    older = lambda days: published < now - F.make_dt_interval(days=F.lit(days))
    by_hand = F.startswith(r["reason"], F.lit(REMOVED_BY_HAND))
    became = r["outcome"].isin("event", "merged")
    of_record = (
        F.when(became & (shown > 0), "shown").when(became & (F.col("n_stored") > 0), "over").when(became, "gone")
        .when(r["outcome"].isin("discarded", "hidden", "rejected"), r["outcome"]).when(by_hand, "removed").otherwise("not_event")
    )
    of_date = (
        F.when(F.col("_first").isNull(), "new_account").when(published > F.coalesce("_read", "_last.finished_at"), "after_last_read")
        .when((published < first_day) & older(first_days), "before_first_read").when(older(lookback), "too_old")
        .when(F.col("_tried.failed"), "last_read_failed").when(F.col("_last.pending"), "waiting").otherwise("unexplained")
    )
    verdict = (
        F.when(F.col("code").isNull(), "not_a_post").when(r.isNotNull(), of_record).when(F.col("of_account").isNull(), "unknown_account").when(~followed_now, "not_followed")
        .when(F.col("_looked").isNull(), "not_looked_up").when(F.col("_problem") == "private", "private").when(F.col("_problem").isNotNull(), "unreadable")
        .when(published.isNull(), "not_in_feed").otherwise(of_date)
    )
    q = q.withColumn("verdict", verdict)
    v = F.col("verdict")
    check = lambda when, mark, name: F.when(when, F.struct(F.lit(mark).alias("mark"), name.alias("check")))
    known, seen = v != "not_a_post", r.isNotNull()
    has_account = F.col("of_account").isNotNull()
    checks = F.array_compact(F.array(
        check(known & ~seen & ~has_account, "info", F.lit("no_record")), check(known & F.col("_with").isNotNull(), "info", F.lit("collaboration")),
        check(known & has_account & followed_now, "ok", F.lit("followed")), check(known & has_account & ~followed_now, "no", F.lit("followed")),
        check(known & seen & ~yes(r["provisional"]), "ok", F.lit("analyzed")), check(known & seen & yes(r["provisional"]), "ok", F.lit("analyzed_for_now")),
        check(seen & (v == "shown") & (r["outcome"] == "merged"), "ok", F.lit("joined_events")), check(seen & (v == "shown") & (r["outcome"] != "merged"), "ok", F.lit("became_events")),
        check(v == "over", "info", v), check(seen & ~v.isin("shown", "over"), "no", v),
        check(known & ~seen & followed_now, "info", F.lit("not_analyzed")), check(v.isin("private", "unreadable", "not_in_feed"), "no", v),
        check(known & ~seen & followed_now & F.col("_looked") & F.col("_problem").isNull() & published.isNotNull(), "ok", F.lit("published")),
    ))
    parts = F.filter(F.split(F.coalesce(r["detail"], F.lit("")), ", "), lambda x: x != "")
    after = F.btrim(F.substring(r["reason"], F.lit(len(REMOVED_BY_HAND) + 1), F.length(r["reason"])), F.lit(" :"))
    details = (
        F.when(v == "discarded", F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit(NO_DETAIL)))).when(v.isin("rejected", "not_event"), F.array(r["reason"]))
        .when(v == "removed", F.array(after)).when(v == "unreadable", F.array("_problem")).otherwise(F.array().cast("array<string>"))
    )
    none = F.array().cast("array<struct<last_day:date,id:string,title:string>>")
    return q.select(*[F.col(c) for c in asked.columns], "code", "of_account", "verdict", v.isin(ADD).alias("add"), checks.alias("checks"), details.alias("details"), F.coalesce("shown", none).alias("shown"))
