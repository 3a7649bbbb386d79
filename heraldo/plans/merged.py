"""Queries on stored events merged in input order, moments within spans, and records refused, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from heraldo.operators import duplicates, series, spans
from heraldo.sources import quarantine
from heraldo.sources.tables import table

FIELDS = ["title", "event_type", "venue", "start_time", "end_time", "date", "end_date", "sessions"]


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as one-day events, thirty customers an account, moved to their month's first day so that some share one; some lack a start or venue."""
    k, none = F.col("o_orderkey"), F.lit(None).cast("string")
    events = table(spark, sf_dir, "orders").select(
        k.alias("id"), k.alias("pos"), F.floor(F.col("o_custkey") / 30).alias("account"), F.array(F.concat(F.lit("p"), (F.col("o_custkey") % 20).cast("string"))).alias("posts"), (k * 7919 % 1000).alias("seen"),
        F.col("o_orderpriority").alias("title"), none.alias("event_type"), F.when(k % 4 > 0, F.col("o_orderstatus")).alias("venue"), F.when(k % 3 > 0, F.when(k % 5 > 1, "20:00").otherwise("21:00")).alias("start_time"),
        none.alias("end_time"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("date"), F.lit(None).cast("date").alias("end_date"), F.lit(None).cast("array<struct<date:date,start_time:string,end_time:string>>").alias("sessions"),
    )
    return duplicates.merge_duplicates(events, FIELDS)


def merge_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    dropped = F.array_join(F.transform(F.array_sort("dropped"), lambda x: x.cast("string")), ",")
    return _merged(spark, sf_dir).select("id", "account", "date", "title", "venue", "start_time", "seen", F.array_join(F.array_sort("posts"), ",").alias("posts"), dropped.alias("dropped"))


def rewritten_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's orders as the events that a post names, after the merge."""
    records = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("ids"))
    out = duplicates.rewritten(records, duplicates.renamed(_merged(spark, sf_dir)), "o_custkey", "ids")
    return out.select("o_custkey", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


def moments_in_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each event the first of its user's purchases whose hour to two weeks after it the event falls in."""
    events = table(spark, sf_dir, "events").withColumn("at", series.micros(F.col("ts")))
    bought = events.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("span"), F.col("at").alias("first"), (F.col("at") + (1 + F.col("event_id") % 336) * 3_600_000_000).alias("last"))
    return spans.containing(events.select("user_id", "event_id", "at"), bought, "event_id", "span", "at", "first", "last", ["user_id"], 3_600_000_000)


def refused_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON texts of which some are cut off, lack a field, have one more or hold what can't be: why each is refused."""
    k = F.col("o_orderkey")
    day = F.when(k % 19 == 0, "1996-13-01").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    whole = F.to_json(F.struct(F.concat(F.when(k % 13 == 0, "x").otherwise(""), k.cast("string")).alias("id"), F.when(k % 11 > 0, F.col("o_orderstatus")).alias("status"), day.alias("day"), F.when(k % 17 == 0, True).alias("more")))
    number = F.when(k % 13 == 0, whole).otherwise(F.regexp_replace(whole, '"id":"([0-9]+)"', '"id":$1'))
    text = F.when(k % 7 == 0, F.substring(number, F.lit(1), F.length(number) - 1)).when(k % 23 == 0, " ").otherwise(number)
    schema = StructType.fromDDL("id long, status string, day string")
    rules = {"no such day": lambda r: F.try_to_timestamp(r["day"], F.lit("yyyy-MM-dd")).isNull()}
    found = quarantine.sorted_records(table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text")), "text", schema, ["id", "status"], rules)
    return found.select("o_orderkey", F.array_join("reasons", ", ").alias("reasons"), F.when(F.size("reasons") == 0, F.struct("record.*")).alias("r")).select("o_orderkey", "reasons", "r.*")


QUERIES = {f.__name__: f for f in (merge_duplicates, rewritten_references, moments_in_spans, refused_records)}

# one event of each account's month a round, against the list of those kept so far
_FOLD = """
WITH RECURSIVE e AS (
  SELECT o_custkey // 30 AS account, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, row_number() OVER (PARTITION BY o_custkey // 30, date_trunc('month', o_orderdate) ORDER BY o_orderkey) AS n,
    {'id': o_orderkey, 'title': o_orderpriority, 'venue': CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus END, 'start': CASE WHEN o_orderkey % 3 > 0 THEN CASE WHEN o_orderkey % 5 > 1 THEN '20:00' ELSE '21:00' END END,
     'seen': o_orderkey * 7919 % 1000, 'posts': ['p' || (o_custkey % 20)], 'dropped': CAST([] AS BIGINT[])} AS v FROM orders),
s AS (
  SELECT account, date, n, [v] AS kept FROM e WHERE n = 1
  UNION ALL
  SELECT account, date, n, CASE WHEN spot IS NULL OR spot = 0 THEN list_append(kept, v) ELSE list_transform(kept, lambda k, i: CASE WHEN i = spot THEN
      {'id': keep.id, 'title': keep.title, 'venue': coalesce(keep.venue, away.venue), 'start': CASE WHEN away.start IS NULL THEN keep.start WHEN keep.start IS NULL OR away.seen >= keep.seen THEN away.start ELSE keep.start END,
       'seen': greatest(keep.seen, away.seen), 'posts': list_concat(keep.posts, away.posts), 'dropped': list_concat(list_append(keep.dropped, away.id), away.dropped)} ELSE k END) END
  FROM (SELECT *, CASE WHEN fuller THEN twin ELSE v END AS keep, CASE WHEN fuller THEN v ELSE twin END AS away FROM (
    SELECT *, (twin.venue IS NOT NULL)::INT + (twin.start IS NOT NULL)::INT > (v.venue IS NOT NULL)::INT + (v.start IS NOT NULL)::INT
      OR ((twin.venue IS NOT NULL)::INT + (twin.start IS NOT NULL)::INT = (v.venue IS NOT NULL)::INT + (v.start IS NOT NULL)::INT AND length(twin.title) >= length(v.title)) AS fuller FROM (
      SELECT *, kept[spot] AS twin FROM (
        SELECT s.account, s.date, e.n, s.kept, e.v, list_position(list_transform(s.kept, lambda k: NOT list_has_any(k.posts, e.v.posts) AND CASE WHEN k.start IS NOT NULL AND e.v.start IS NOT NULL THEN k.start = e.v.start ELSE k.title = e.v.title END), true) AS spot
        FROM s JOIN e ON e.account = s.account AND e.date = s.date AND e.n = s.n + 1))))),
last AS (SELECT account, date, arg_max(kept, n) AS kept FROM s GROUP BY 1, 2), m AS (SELECT account, date, unnest(kept) AS k FROM last)
"""
ORACLE_SQL = {
    "merge_duplicates": _FOLD + "SELECT k.id AS id, account, date, k.title AS title, k.venue AS venue, k.start AS start_time, k.seen AS seen, array_to_string(list_sort(list_distinct(k.posts)), ',') AS posts, array_to_string(list_sort(k.dropped), ',') AS dropped FROM m",
    "rewritten_references": _FOLD + """, r AS (SELECT unnest(k.dropped) AS gone, k.id AS kept FROM m),
o AS (SELECT o_custkey, coalesce(kept, o_orderkey) AS id, min(o_orderkey) AS spot FROM orders LEFT JOIN r ON gone = o_orderkey GROUP BY 1, 2)
SELECT o_custkey, string_agg(CAST(id AS VARCHAR), ',' ORDER BY spot) AS ids FROM o GROUP BY 1""",
    "moments_in_spans": """
WITH p AS (SELECT user_id, event_id AS span, ts AS first, ts + to_hours(CAST(1 + event_id % 336 AS INTEGER)) AS last FROM events WHERE event_type = 'purchase')
SELECT event_id, arg_min(span, row(first, span)) AS span, count(span) AS n FROM events e LEFT JOIN p ON p.user_id = e.user_id AND ts BETWEEN first AND last GROUP BY 1""",
    "refused_records": """
WITH r AS (SELECT *, CASE WHEN o_orderkey % 7 = 0 THEN 'not JSON' WHEN o_orderkey % 23 = 0 THEN 'empty' ELSE concat_ws(', ', CASE WHEN o_orderkey % 13 = 0 THEN 'wrong type' END,
  CASE WHEN o_orderkey % 11 = 0 THEN 'missing status' END, CASE WHEN o_orderkey % 17 = 0 THEN 'unknown more' END, CASE WHEN o_orderkey % 19 = 0 THEN 'no such day' END) END AS reasons FROM orders)
SELECT o_orderkey, reasons, CASE WHEN reasons = '' THEN o_orderkey END AS id, CASE WHEN reasons = '' THEN o_orderstatus END AS status, CASE WHEN reasons = '' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM r""",
}
