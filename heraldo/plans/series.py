"""Queries over ordered events: streaks, rolling frames, gaps, budgets and slots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heraldo.operators import series
from heraldo.sources.tables import table

STAMP = "yyyy-MM-dd HH:mm:ss"


def streak_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = series.latest_streak(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error")
    return out.select("user_id", "streak", series.level(F.col("streak"), 2).alias("level"))


def streak_skipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = series.latest_streak(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", F.col("event_type") != "view")
    return out.where("streak > 0")


def stuck_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return series.stuck(daily, ["user_id"], "day", "n")


def quiet_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_type = lambda t: (F.col("event_type") == t).cast("int")
    out = series.rolling(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], 21, purchases=is_type("purchase"), errors=is_type("error"))
    return out.where("in_frame = 21 and purchases = 0").select("event_id", "user_id", "errors")


def rolling_cost_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs = series.rises(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "value").where("rise > 0")
    out = series.cost_forecast(costs, ["user_id"], ["ts", "event_id"], "rise")
    return out.select("event_id", F.round("rise", 4).alias("cost"), F.round("forecast", 4).alias("forecast"))


def gap_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = series.gap_islands(table(spark, sf_dir, "events"), ["user_id"], "ts", ["ts", "event_id"], 6 * 3600)
    return out.select("user_id", F.date_format("first_at", STAMP).alias("first_at"), F.date_format("last_at", STAMP).alias("last_at"), "n")


def sliding_minute_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = series.sliding_budget(table(spark, sf_dir, "events"), ["user_id"], "ts", "value", 24 * 3600, 150.0)
    return out.select("event_id", F.round("used", 2).alias("used"), F.round("over", 2).alias("over"))


def pacing_wait(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = series.pacing(table(spark, sf_dir, "events"), ["event_type"], "ts", ["ts", "event_id"], 0.1)
    return out.select("event_id", F.round("wait", 3).alias("wait"))


def missed_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.missed_slots(table(spark, sf_dir, "events"), "user_id", "ts")


def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.superseded(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_custkey")


def image_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = series.image_ranges(table(spark, sf_dir, "lineitem").where("l_quantity >= 1"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "l_linenumber")
    return out.groupBy("l_orderkey").agg(F.max("end_image").alias("images"), F.sum("first_image").alias("starts"))


QUERIES = {f.__name__: f for f in (streak_latest, streak_skipping, stuck_backlog, quiet_window, rolling_cost_forecast, gap_sessions, sliding_minute_budget, pacing_wait, missed_slots, latest_version, image_ranges)}

ORACLE_SQL = {
    "streak_latest": """
WITH w AS (SELECT user_id, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS misses FROM events),
s AS (SELECT user_id, count(*) FILTER (misses = 0) AS streak FROM w GROUP BY 1)
SELECT user_id, streak, CASE WHEN streak >= 2 THEN 'warning' WHEN streak >= 1 THEN 'notice' END AS level FROM s""",
    "streak_skipping": """
WITH w AS (SELECT user_id, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS misses FROM events WHERE event_type <> 'view')
SELECT user_id, count(*) AS streak FROM w WHERE misses = 0 GROUP BY 1""",
    "stuck_backlog": """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day DESC) AS k FROM d)
SELECT user_id, max(n) FILTER (k = 4) AS first_count, max(n) FILTER (k = 1) AS last_count FROM r WHERE k <= 4 GROUP BY 1
HAVING count(*) = 4 AND max(n) FILTER (k = 1) >= max(n) FILTER (k = 4)""",
    "quiet_window": """
WITH w AS (SELECT event_id, user_id, count(*) OVER f AS c, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER f AS p,
  sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER f AS e FROM events WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 20 PRECEDING AND CURRENT ROW))
SELECT event_id, user_id, CAST(e AS BIGINT) AS errors FROM w WHERE c = 21 AND p = 0""",
    "rolling_cost_forecast": """
WITH d AS (SELECT event_id, user_id, ts, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rise FROM events),
m AS (SELECT *, max(rise) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS most FROM d WHERE rise > 0)
SELECT event_id, round(rise, 4) AS cost, round(CASE WHEN most IS NULL THEN 4.0 ELSE greatest(1.0, most) END, 4) AS forecast FROM m""",
    "gap_sessions": """
WITH l AS (SELECT user_id, event_id, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 21600000000 THEN 1 ELSE 0 END AS new FROM events),
i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM l)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_at, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_at, count(*) AS n FROM i GROUP BY user_id, island""",
    "sliding_minute_budget": """
WITH w AS (SELECT event_id, sum(value) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW) AS used FROM events)
SELECT event_id, round(used, 2) AS used, round(greatest(0.0, used - 150.0), 2) AS over FROM w""",
    "pacing_wait": """
SELECT event_id, round(coalesce(greatest(0.0, 600.5 - (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id))) / 1000000.0), 0.0), 3) AS wait FROM events""",
    "missed_slots": """
WITH seen AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, CASE WHEN hour(ts) * 60 + minute(ts) BETWEEN 180 AND 359 THEN 180 WHEN hour(ts) * 60 + minute(ts) BETWEEN 390 AND 569 THEN 390 WHEN hour(ts) >= 21 THEN 1260 END AS slot FROM events),
spans AS (SELECT user_id, min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events GROUP BY 1),
days AS (SELECT user_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM spans),
c AS (SELECT user_id, day, unnest([180, 390, 1260]) AS slot FROM days),
m AS (SELECT c.* FROM c LEFT JOIN seen s ON s.user_id = c.user_id AND s.day = c.day AND s.slot = c.slot WHERE s.user_id IS NULL)
SELECT user_id, slot, day FROM (SELECT *, lag(day) OVER (PARTITION BY user_id, slot ORDER BY day) AS before FROM m) WHERE date_diff('day', before, day) = 1""",
    "latest_version": """
SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k > 1""",
    "image_ranges": """
WITH w AS (SELECT l_orderkey, l_linenumber AS n, sum(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS UNBOUNDED PRECEDING) AS e FROM lineitem WHERE l_quantity >= 1)
SELECT l_orderkey, CAST(max(e) AS BIGINT) AS images, CAST(sum(e - n) AS BIGINT) AS starts FROM w GROUP BY 1""",
}
