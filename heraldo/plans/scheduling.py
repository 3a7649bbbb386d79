"""Queries on who is due, productive, late or busy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heraldo.operators import schedule
from heraldo.sources.tables import table


def unproductive_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekly = table(spark, sf_dir, "events").select("user_id", F.to_date(F.date_trunc("week", "ts")).alias("week"), "event_type")
    return schedule.unproductive(weekly, ["user_id", "week"], F.col("event_type") == "purchase")


def lead_days_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey", "l_shipdate")
    pairs = lines.join(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey")
    return schedule.short_notice(schedule.lead_days(pairs, "l_suppkey", "o_orderdate", "l_shipdate"), "l_suppkey", below=None)


def missed_first_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule.missed_after_first(table(spark, sf_dir, "events"), "user_id", "ts", F.col("event_type") == "error")


def busy_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return schedule.busy(events.where("event_type = 'purchase' and ts >= timestamp_ntz'2024-01-29 00:00:00'").select("user_id"), events.where("event_type = 'signup' and value > 100").select("user_id"))


def dominant_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule.dominant(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_returnflag")


def hours_overdue(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("last_at"), F.count("*").alias("n"), F.count_if(F.col("event_type") == "purchase").alias("p"))
    late = schedule.hours_overdue(F.col("last_at"), now, F.col("p") == 0, F.col("p") < 0.2 * F.col("n"))
    ranked = users.select("user_id", F.round(late, 4).alias("overdue"))
    return schedule.due(ranked, [F.col("overdue").desc(), F.col("user_id")])


def urgency_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    upcoming = table(spark, sf_dir, "orders").where("o_orderstatus = 'O' and o_orderdate >= timestamp_ntz'1998-01-01 00:00:00'")
    soonest = upcoming.groupBy("o_custkey").agg(F.min(F.struct("o_orderdate", "o_orderkey")).alias("first"), F.count("*").alias("waiting"))
    return soonest.select("o_custkey", F.to_date("first.o_orderdate").alias("day"), F.col("first.o_orderkey").alias("o_orderkey"), "waiting").orderBy("day", "o_orderkey").limit(50)


def read_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    newer = table(spark, sf_dir, "events").where("ts >= timestamp_ntz'2024-01-25 00:00:00'").groupBy("user_id").agg(F.count("*").alias("newer"))
    return newer.select("user_id", schedule.read_depth(F.col("newer")).alias("depth"))


QUERIES = {f.__name__: f for f in (unproductive_keys, lead_days_median, missed_first_window, busy_union, dominant_share, hours_overdue, urgency_queue, read_depth)}

ORACLE_SQL = {
    "unproductive_keys": """
SELECT user_id, CAST(date_trunc('week', ts) AS DATE) AS week, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) >= 10 AND NOT bool_or(event_type = 'purchase')""",
    "lead_days_median": """
WITH l AS (SELECT l_suppkey, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS lead FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_suppkey, count(*) AS n, CAST(median(lead) AS DOUBLE) AS median_days FROM l WHERE lead >= 0 GROUP BY 1 HAVING count(*) >= 3""",
    "missed_first_window": """
WITH f AS (SELECT user_id, min(ts) AS first_at FROM events GROUP BY 1)
SELECT e.user_id, count(*) AS n FROM events e JOIN f ON f.user_id = e.user_id WHERE event_type = 'error' AND ts >= first_at + INTERVAL 12 HOUR GROUP BY 1""",
    "busy_union": """
SELECT user_id FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-29 00:00:00' UNION SELECT user_id FROM events WHERE event_type = 'signup' AND value > 100""",
    "dominant_share": """
WITH c AS (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2), t AS (SELECT *, CAST(sum(n) OVER (PARTITION BY l_orderkey) AS BIGINT) AS total FROM c)
SELECT * FROM t WHERE total >= 3 AND n >= 0.8 * total""",
    "hours_overdue": """
WITH u AS (SELECT user_id, max(ts) AS last_at, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS p FROM events GROUP BY 1),
o AS (SELECT user_id, round((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(last_at)) / 3600000000.0 - CASE WHEN p = 0 THEN 164 WHEN p < 0.2 * n THEN 46 ELSE 22 END, 4) AS overdue FROM u)
SELECT user_id, overdue FROM (SELECT *, row_number() OVER (ORDER BY overdue DESC, user_id) AS k, count(*) OVER () AS c FROM o) WHERE k <= ceil(c / 3.0) + 5""",
    "urgency_queue": """
SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS day, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, count(*) AS waiting FROM orders
WHERE o_orderstatus = 'O' AND o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1 ORDER BY 2, 3 LIMIT 50""",
    "read_depth": """
SELECT user_id, least(greatest(count(*) + 5, 10), 50) AS depth FROM events WHERE ts >= TIMESTAMP '2024-01-25' GROUP BY 1""",
}
