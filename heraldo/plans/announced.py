"""Registered queries of sessions, merging, filters, orders and labels, over rows derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heraldo.functions import labels
from heraldo.functions.cancellation import says_cancelled
from heraldo.operators import filters, merging, schedule, sessions
from heraldo.sources.tables import table


def _series(spark: SparkSession, sf_dir: str, ordered: bool) -> DataFrame:
    """Each customer's orders of a year as the sessions of a series; `ordered` by day, else by key."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"))
    placed = F.struct("day", "o_orderkey") if ordered else F.struct("o_orderkey", "day")
    return orders.groupBy("o_custkey", F.year("day").alias("year")).agg(F.array_sort(F.collect_list(placed)).alias("s"))


def fit_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.transform("s", lambda x: F.struct(F.date_format(x["day"], "yyyy-MM-dd").alias("date"), F.lit(None).cast("string").alias("start_time"), F.lit("21:00").alias("end_time")))
    none = F.lit(None).cast("string")
    read = _series(spark, sf_dir, True).select("o_custkey", "year", sessions.parsed_sessions(raw, F.lit("09:00"), none).alias("sessions"), F.lit(None).cast("date").alias("date"), F.lit(None).cast("date").alias("end_date"), none.alias("start_time"), none.alias("end_time"), none.alias("weekday"), F.lit(False).alias("is_recurring"), F.array().cast("array<string>").alias("doubts"))
    fitted = sessions.fit_sessions(read)
    return fitted.select("o_custkey", "year", "date", "end_date", "weekday", "is_recurring", "start_time", F.coalesce(F.size("sessions"), F.lit(-1)).cast("long").alias("n"))


def series_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = _series(spark, sf_dir, False).select("o_custkey", "year", F.transform("s", lambda x: F.struct(x["day"].alias("date"))).alias("s"))
    days = F.transform("s", lambda x: x["date"])
    problems = sessions.series_problems(F.col("s"), F.array_min(days), F.array_max(days))
    return held.select("o_custkey", "year", F.array_join(problems, ", ").alias("problems"), sessions.increasing(days).alias("increasing"))


def merge_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders as posts of one event, each of one day, read by key and published by day."""
    session = "array<struct<date:date,start_time:string,end_time:string>>"
    posts = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.struct(F.to_date("o_orderdate").alias("d"), "o_orderkey").alias("seen"), F.to_date("o_orderdate").alias("date"), F.lit(None).cast("date").alias("end_date"), F.lit(None).cast(session).alias("sessions"), F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority")).alias("title"), F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderstatus")).alias("start_time"))
    return merging.merged_in_order(posts, "o_custkey", "o_orderkey", "seen", ["title", "start_time"]).select("o_custkey", "title", "start_time", "date")


def ended_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("first"), F.when(F.col("o_orderkey") % 3 > 0, F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 7).cast("int"))).alias("end"), "o_orderpriority")
    last, today = filters.last_day(F.col("first"), F.col("end")), F.lit("1996-06-15").cast("date")
    return spans.groupBy("o_orderpriority").agg(F.count_if(filters.has_ended(last, today)).alias("ended"), F.count_if(filters.is_upcoming(last, today)).alias("upcoming"))


def quiet_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.groupBy("event_type").agg(F.count_if(filters.near_slot(F.col("ts"), ["06:30", "13:00", "23:30"])).alias("quiet"), F.count("*").alias("n"))


def price_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_linenumber") == 7, 0).otherwise(F.floor("l_extendedprice")).cast("long").alias("amount"))
    return lines.groupBy("l_orderkey").agg(labels.price_label(F.collect_list("amount")).alias("label"))


def first_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    links = lines.where("l_quantity > 40").select(F.col("l_orderkey").alias("id"), F.to_date("l_shipdate").alias("processed_at"))
    return filters.first_published(links, orders.select(F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("published")), "id")


def second_opinions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    records = events.select("user_id", F.when(F.col("event_id") % 3 > 0, F.col("event_type")).alias("outcome"), (F.col("event_id") % 5 == 0).alias("flagged"))
    had = filters.had_events(F.when(F.col("outcome") == "purchase", "event").otherwise(F.col("outcome")), F.col("flagged"))
    return filters.second_opinions(events.where("event_type = 'error'").select("user_id", "event_id", "ts"), records, "user_id", "ts", "event_id", had, schedule.UNPRODUCTIVE_AFTER).select("user_id", "event_id", F.col("tier").cast("long").alias("tier"))


def publishable(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    why = F.array_compact(F.array(F.when(F.col("o_orderstatus") == "P", "recurrente"), F.when(F.col("o_orderkey") % 11 == 0, "sin fecha")))
    kept, lost = filters.publishable(orders.select("o_custkey", "o_orderkey", why.alias("why")), "o_custkey", "why")
    counts = kept.groupBy("o_custkey").agg(F.count("*").alias("kept"))
    return counts.join(lost, "o_custkey", "full").select("o_custkey", F.coalesce("kept", F.lit(0)).cast("long").alias("kept"), F.array_join(F.coalesce("reasons", F.array().cast("array<string>")), ",").alias("reasons"))


def latest_try(spark: SparkSession, sf_dir: str) -> DataFrame:
    tried = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select("o_custkey", "o_orderkey", "o_orderstatus", F.struct("o_orderdate", "o_orderkey").alias("at"))
    return filters.latest_try(tried, "o_custkey", "at").select("o_custkey", "o_orderkey", "o_orderstatus")


def carried_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    year = lambda y: orders.where(F.year("day") == y)
    followed = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return filters.carried_over(year(1995), year(1996), followed, "o_custkey")


def refused_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.sequence(F.to_date("o_orderdate"), F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 40).cast("int"))).alias("days"))
    first = spans.groupBy("o_custkey").agg(F.min_by("days", "o_orderkey").alias("days_a"), F.min("o_orderkey").alias("linked"))
    pairs = spans.withColumnRenamed("days", "days_b").join(first, "o_custkey").where("o_orderkey > linked")
    return filters.refused_links(pairs).select("o_orderkey", "linked")


def cancel_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each whole text says that something is off. Scoping within clauses is beyond SQL; fixtures test it."""
    return table(spark, sf_dir, "documents").select("doc_id", says_cancelled(F.col("text")).alias("cancelled"))


def handles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' names as handles read in images, every third cut off."""
    read = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("@"), F.regexp_replace("s_name", "[^A-Za-z0-9]", "_"), F.when(F.col("s_suppkey") % 3 == 0, "…").otherwise(" ")).alias("t"))
    return read.select("s_suppkey", labels.read_handle(F.col("t")).alias("h")).select("s_suppkey", "h.name", "h.cut")


QUERIES = {f.__name__: f for f in (fit_sessions, series_problems, merge_posts, ended_events, quiet_times, price_labels, first_published, second_opinions, publishable, latest_try, carried_over, refused_links, cancel_scan, handles)}

_DAYS = "SELECT o_custkey, year(CAST(o_orderdate AS DATE)) AS year, o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders"
ORACLE_SQL = {
    "fit_sessions": f"""
WITH o AS ({_DAYS}), g AS (SELECT o_custkey, year, count(DISTINCT day) AS c, min(day) AS a, max(day) AS b FROM o GROUP BY 1, 2),
k AS (SELECT *, CASE WHEN c < 2 THEN 'none' WHEN b - a = c - 1 AND c <= 7 THEN 'run' WHEN c > 12 OR b - a + 1 > 123 THEN 'course' ELSE 'series' END AS kind FROM g)
SELECT o_custkey, CAST(year AS INTEGER) AS year, CASE WHEN kind IN ('run', 'series') THEN a END AS date, CASE WHEN kind IN ('run', 'series') THEN b END AS end_date,
  CASE WHEN kind = 'series' THEN ['lunes', 'martes', 'miércoles', 'jueves', 'viernes', 'sábado', 'domingo'][isodow(a)] END AS weekday, kind = 'course' AS is_recurring,
  CASE WHEN kind = 'series' THEN '09:00' END AS start_time, CASE WHEN kind = 'series' THEN c ELSE -1 END AS n FROM k""",
    "series_problems": f"""
WITH o AS ({_DAYS}), l AS (SELECT *, lag(day) OVER (PARTITION BY o_custkey, year ORDER BY o_orderkey) AS before FROM o),
g AS (SELECT o_custkey, year, count(*) AS c, min(day) AS a, max(day) AS b, bool_and(before IS NULL OR before < day) AS up, arg_min(day, o_orderkey) AS f, arg_max(day, o_orderkey) AS t FROM l GROUP BY 1, 2)
SELECT o_custkey, CAST(year AS INTEGER) AS year, concat_ws(', ', CASE WHEN c NOT BETWEEN 2 AND 12 THEN 'count' END, CASE WHEN NOT up THEN 'out of order' WHEN b - a + 1 > 123 THEN 'too long' END,
  CASE WHEN f <> a OR t <> b THEN 'days don''t frame it' END) AS problems, up AS increasing FROM g""",
    "merge_posts": """
WITH p AS (SELECT o_custkey, o_orderkey AS k, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS title, CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus END AS st FROM orders),
m AS (SELECT *, row(day, k) >= max(row(day, k)) OVER (PARTITION BY o_custkey ORDER BY k) AS newest, first_value(st IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY k ROWS UNBOUNDED PRECEDING) AS s FROM p)
SELECT o_custkey, arg_min(title, k) FILTER (title IS NOT NULL) AS title, coalesce(arg_max(st, k) FILTER (newest AND st IS NOT NULL AND k >= f), any_value(fs)) AS start_time, arg_max(day, row(day, k)) AS date
FROM (SELECT *, min(CASE WHEN st IS NOT NULL THEN k END) OVER (PARTITION BY o_custkey) AS f, arg_min(st, CASE WHEN st IS NOT NULL THEN k END) OVER (PARTITION BY o_custkey) AS fs FROM m) GROUP BY 1""",
    "ended_events": """
WITH s AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderkey % 7 AS INTEGER) ELSE 0 END AS last FROM orders)
SELECT o_orderpriority, count(*) FILTER (last < DATE '1996-06-15') AS ended, count(*) FILTER (last >= DATE '1996-06-15') AS upcoming FROM s GROUP BY 1""",
    "quiet_times": """
WITH m AS (SELECT event_type, CAST(ts AS TIME) AS t FROM events)
SELECT event_type, count(*) FILTER ((t >= TIME '05:30' AND t < TIME '07:15') OR (t >= TIME '12:00' AND t < TIME '13:45') OR t >= TIME '22:30' OR t < TIME '00:15') AS quiet, count(*) AS n FROM m GROUP BY 1""",
    "price_labels": """
WITH a AS (SELECT l_orderkey, min(CASE WHEN l_linenumber = 7 THEN 0 ELSE CAST(floor(l_extendedprice) AS BIGINT) END) AS low, count(*) AS c FROM lineitem GROUP BY 1)
SELECT l_orderkey, CASE WHEN low = 0 THEN 'Gratis' ELSE (CASE WHEN c > 1 THEN 'Desde ' ELSE '' END) || '$ ' || replace(format('{:,}', low), ',', '.') END AS label FROM a""",
    "first_published": """
WITH l AS (SELECT l_orderkey AS id, min(CAST(l_shipdate AS DATE)) AS a FROM lineitem WHERE l_quantity > 40 GROUP BY 1), o AS (SELECT o_orderkey AS id, min(CAST(o_orderdate AS DATE)) AS b FROM orders GROUP BY 1)
SELECT id, coalesce(a, b) AS first FROM l FULL JOIN o USING (id)""",
    "second_opinions": """
WITH r AS (SELECT user_id, CASE WHEN event_id % 3 > 0 THEN event_type = 'purchase' ELSE event_id % 5 = 0 END AS had FROM events), s AS (SELECT user_id, bool_or(had) AS p, count(*) AS n FROM r GROUP BY 1)
SELECT user_id, event_id, CAST(CASE WHEN p THEN 0 WHEN n >= 10 THEN 2 ELSE 1 END AS BIGINT) AS tier FROM events JOIN s USING (user_id) WHERE event_type = 'error' ORDER BY tier, ts DESC, event_id LIMIT 12""",
    "publishable": """
WITH o AS (SELECT o_custkey, o_orderstatus = 'P' AS p, o_orderkey % 11 = 0 AS s FROM orders)
SELECT o_custkey, count(*) FILTER (NOT p AND NOT s) AS kept, concat_ws(',', CASE WHEN bool_or(p) THEN 'recurrente' END, CASE WHEN bool_or(s) THEN 'sin fecha' END) AS reasons FROM o GROUP BY 1""",
    "latest_try": "SELECT o_custkey, arg_max(o_orderkey, row(o_orderdate, o_orderkey)) AS o_orderkey, arg_max(o_orderstatus, row(o_orderdate, o_orderkey)) AS o_orderstatus FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1",
    "carried_over": """
SELECT DISTINCT o_custkey FROM orders WHERE year(CAST(o_orderdate AS DATE)) = 1995 AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(CAST(o_orderdate AS DATE)) = 1996)
AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
    "refused_links": """
WITH s AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INTEGER) AS b FROM orders),
f AS (SELECT o_custkey, min(o_orderkey) AS linked FROM s GROUP BY 1)
SELECT s.o_orderkey, f.linked FROM s JOIN f USING (o_custkey) JOIN s l ON l.o_orderkey = f.linked WHERE s.o_orderkey > f.linked AND (s.a > l.b OR l.a > s.b)""",
    "handles": """
SELECT s_suppkey, CASE WHEN length(s_name) BETWEEN 1 AND 30 THEN lower(regexp_replace(s_name, '[^A-Za-z0-9]', '_', 'g')) END AS name, s_suppkey % 3 = 0 AS cut FROM supplier""",
}
