"""Queries on texts and pages, and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heraldo.functions import text
from heraldo.operators import matching
from heraldo.plans import series
from heraldo.sources.tables import table
from heraldo.streaming import sessions

SYNONYMS = {"widget": "salsa linea", "gadget": "salsa", "ring": "bachata", "plate": "bachata sensual", "bolt": "salsa cubana"}


def reads_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    agg = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg("value"), 4).alias("mean"), F.round(F.median("value"), 4).alias("middle"), F.max("value").alias("most"), F.max_by("event_id", F.struct("value", "event_id")).alias("costliest"))
    return agg


def map_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.from_json("props", "map<string,bigint>")
    return table(spark, sf_dir, "events").select("event_type", F.explode(k)).groupBy("event_type", "key").agg(F.sum("value").alias("total"))


def changed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    pairs = table(spark, sf_dir, "orders").withColumn("before", F.lag(F.struct("o_orderstatus", "o_orderpriority")).over(by)).where("before is not null")
    fields = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"before.{c}").eqNullSafe(F.col(c)).alias("same")) for c in ("o_orderstatus", "o_orderpriority")]))
    return pairs.select(fields.alias("f")).groupBy("f.field").agg(F.count("*").alias("compared"), F.count_if(~F.col("f.same")).alias("changed"))


def f1_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", (F.col("n_chars") >= 600).alias("said"))
    both = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("so")).join(docs, "doc_id")
    n = both.groupBy("source").agg(F.count_if(F.col("said") & F.col("so")).alias("found"), F.count_if(F.col("so") & ~F.col("said")).alias("missed"), F.count_if(F.col("said") & ~F.col("so")).alias("extra"))
    return n.withColumn("f1", F.round(F.coalesce(F.try_divide(2.0 * F.col("found"), 2 * F.col("found") + F.col("missed") + F.col("extra")), F.lit(0.0)), 6))


def bounded_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*map(F.lit, ["signup", "purchase", "error", "click", "view"]))
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.array_position(kinds, F.col("event_type")).alias("kind"))
    totals = events.groupBy("user_id").agg(F.count("*").alias("total"))
    first = matching.rank_first(events, ["user_id"], [F.col("kind"), F.col("event_id")], 5)
    return first.join(totals, "user_id").select("user_id", "event_id", F.col("place").cast("long").alias("place"), F.greatest(F.col("total") - 5, F.lit(0)).alias("left_out"))


def history_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.lit("order").alias("source"), F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("day")).orderBy(F.desc("day"), "id").limit(10)
    events = table(spark, sf_dir, "events").select(F.lit("event").alias("source"), F.col("event_id").alias("id"), F.to_date("ts").alias("day")).orderBy(F.desc("day"), "id").limit(10)
    return orders.unionByName(events).orderBy(F.desc("day"), "source", "id").limit(10)


def stratified_pick(spark: SparkSession, sf_dir: str, n: int = 60) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.sha2(F.concat(F.lit("7/"), F.col("doc_id").cast("string")), 256).alias("h"))
    special = docs.where("lang = 'de'").orderBy("h").limit(n // 3)
    rest = docs.where("lang <> 'de'").orderBy("h").limit(n - n // 3)
    return special.unionByName(rest).select("doc_id", "lang")


def normalize_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    styles = text.normal_styles(F.split("p_name", " "), SYNONYMS, ("salsa", "bachata"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(styles, ",").alias("styles"))


def parse_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    written = F.format_string("%s-%02d", F.date_format("o_orderdate", "yyyy-MM"), k % 40)
    hour = F.format_string("%d:%02d", k % 30, k % 70)
    return table(spark, sf_dir, "orders").select("o_orderkey", text.iso_date(written).alias("day"), text.clock(hour).alias("time"))


def html_post(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract(html, "(?s)<title>(.*?)</title>", 1).alias("title"), F.regexp_extract(html, '<html lang="([a-z]+)"', 1).alias("lang"),
        F.regexp_extract(html, '<a href="([^"]*)"', 1).alias("link"), F.sha2(text.html_text(html), 256).alias("text_sha256"),
    )


def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract(url, "^[a-z]+://([^/?#]*)", 1).alias("host"), F.regexp_extract(url, "/([0-9]+)(?:[?#]|$)", 1).alias("code"), F.regexp_extract(url, r"\?([^#]*)", 1).alias("query"), url.rlike("^https://").alias("secure"))


def text_filter_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", F.lower("text").alias("t"), "n_chars")
    said = docs.t.contains("password") | docs.t.contains("license") | docs.t.contains("token")
    return docs.where(said).groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


def review_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rules = [("urgent", F.col("o_orderpriority").startswith("1")), ("large", F.col("o_totalprice") > 400000), ("pending", F.col("o_orderstatus") == "P")]
    reasons = F.array_compact(F.array(*[F.when(c, F.lit(r)) for r, c in rules]))
    return orders.select("o_orderkey", F.array_join(reasons, ",").alias("reasons")).where("reasons <> ''")


def doc_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"), F.count_if(F.col("event_type") == "purchase").alias("bought"))
    rule = lambda level, key, when: users.where(when).select("user_id", F.lit(level).alias("level"), F.lit(key).alias("key"))
    found = rule("warning", "many errors", "errors >= 20").unionByName(rule("notice", "some errors", "errors between 15 and 19")).unionByName(rule("warning", "buys little", "bought * 10 < n"))
    return found.orderBy(F.col("level") != "warning", "user_id", "key")


def status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda name, **kw: table(spark, sf_dir, name).agg(*[v.alias(k) for k, v in kw.items()])
    parts = [one("orders", orders=F.count("*"), last_day=F.to_date(F.max("o_orderdate"))), one("lineitem", lines=F.count("*"), returned=F.count_if(F.col("l_returnflag") == "R")), one("events", events=F.count("*"), users=F.count_distinct("user_id")), one("documents", documents=F.count("*"), chars=F.sum("n_chars"))]
    out = parts[0].withColumn("one", F.lit(1))
    for part in parts[1:]:  # each side is one row
        out = out.join(part.withColumn("one", F.lit(1)), "one")
    return out.drop("one")


def rollup_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "events")
    path = sessions.scratch(spark)
    # sessions that end near the last row stay open until the watermark passes: one far later row closes them
    marks = f"{path}/in"
    rows = source.select("user_id", F.col("ts").cast("timestamp").alias("at"))
    rows.write.parquet(f"{marks}/part=1")
    rows.agg(F.max("at").alias("at")).select(F.lit(-1).cast("long").alias("user_id"), (F.col("at") + F.expr("interval 90 days")).alias("at")).write.parquet(f"{marks}/part=2")
    stream = spark.readStream.schema("user_id long, at timestamp").option("recursiveFileLookup", "true").parquet(marks)
    out = sessions.run_once(sessions.session_counts(stream, "user_id", "at", "6 hours", "31 days"), path)
    return out.where("user_id >= 0").select("user_id", F.date_format("first_at", "yyyy-MM-dd HH:mm:ss").alias("first_at"), F.date_format("last_at", "yyyy-MM-dd HH:mm:ss").alias("last_at"), "n")


QUERIES = {f.__name__: f for f in (reads_summary, map_sum, changed_fields, f1_score, bounded_changes, history_merge, stratified_pick, normalize_styles, parse_or_null, html_post, url_parts, text_filter_cascade, review_reasons, doc_findings, status_rollup, rollup_counters, stream_sessions)}

ORACLE_SQL = {
    "reads_summary": """
SELECT event_type, count(*) AS n, round(avg(value), 4) AS mean, round(median(value), 4) AS middle, max(value) AS most, arg_max(event_id, (value, event_id)) AS costliest FROM events GROUP BY 1""",
    "map_sum": "SELECT event_type, 'k' AS key, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1",
    "changed_fields": """
WITH l AS (SELECT o_orderstatus AS s, o_orderpriority AS p, lag(o_orderstatus) OVER w AS ls, lag(o_orderpriority) OVER w AS lp FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
SELECT 'o_orderstatus' AS field, count(*) AS compared, count(*) FILTER (s <> ls) AS changed FROM l WHERE ls IS NOT NULL
UNION ALL SELECT 'o_orderpriority', count(*), count(*) FILTER (p <> lp) FROM l WHERE ls IS NOT NULL""",
    "f1_score": """
WITH b AS (SELECT source, n_chars >= 600 AS said, quality = 1 AS so FROM labels JOIN documents USING (doc_id)),
n AS (SELECT source, count(*) FILTER (said AND so) AS found, count(*) FILTER (so AND NOT said) AS missed, count(*) FILTER (said AND NOT so) AS extra FROM b GROUP BY 1)
SELECT *, round(CASE WHEN 2 * found + missed + extra = 0 THEN 0.0 ELSE 2.0 * found / (2 * found + missed + extra) END, 6) AS f1 FROM n""",
    "bounded_changes": """
WITH e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY list_position(['signup', 'purchase', 'error', 'click', 'view'], event_type), event_id) AS place, count(*) OVER (PARTITION BY user_id) AS total FROM events)
SELECT user_id, event_id, place, greatest(total - 5, 0) AS left_out FROM e WHERE place <= 5""",
    "history_merge": """
WITH o AS (SELECT 'order' AS source, o_orderkey AS id, CAST(o_orderdate AS DATE) AS day FROM orders ORDER BY day DESC, id LIMIT 10),
e AS (SELECT 'event' AS source, event_id AS id, CAST(ts AS DATE) AS day FROM events ORDER BY day DESC, id LIMIT 10)
SELECT * FROM (SELECT * FROM o UNION ALL SELECT * FROM e) ORDER BY day DESC, source, id LIMIT 10""",
    "stratified_pick": """
WITH d AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang = 'de' ORDER BY sha256('7/' || doc_id)) AS k FROM documents)
SELECT doc_id, lang FROM d WHERE k <= CASE WHEN lang = 'de' THEN 20 ELSE 40 END""",
    "normalize_styles": """
WITH w AS (SELECT p_partkey, list_transform(string_split(p_name, ' '), lambda w: CASE w WHEN 'widget' THEN 'salsa linea' WHEN 'gadget' THEN 'salsa' WHEN 'ring' THEN 'bachata' WHEN 'plate' THEN 'bachata sensual' WHEN 'bolt' THEN 'salsa cubana' ELSE 'otro' END) AS s FROM part),
d AS (SELECT p_partkey, list_filter(s, lambda x, i: list_position(s, x) = i) AS s FROM w)
SELECT p_partkey, array_to_string(list_filter(s, lambda x: NOT (x IN ('salsa', 'bachata') AND len(list_filter(s, lambda y: starts_with(y, x || ' '))) > 0)), ',') AS styles FROM d""",
    "parse_or_null": """
WITH w AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-') || lpad(CAST(o_orderkey % 40 AS VARCHAR), 2, '0') AS d, o_orderkey % 30 AS h, o_orderkey % 70 AS m FROM orders)
SELECT o_orderkey, TRY_CAST(d AS DATE) AS day, CASE WHEN h < 24 AND m < 60 THEN lpad(CAST(h AS VARCHAR), 2, '0') || ':' || lpad(CAST(m AS VARCHAR), 2, '0') END AS time FROM w""",
    "html_post": r"""
WITH t AS (SELECT *, regexp_replace(regexp_replace(html, '(?is)<(script|style)\b.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g') AS b FROM pages)
SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang, regexp_extract(html, '<a href="([^"]*)"', 1) AS link,
  sha256(trim(regexp_replace(replace(replace(replace(replace(replace(replace(b, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '[ \t\r\n]+', ' ', 'g'))) AS text_sha256 FROM t""",
    "url_parts": r"""
SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(url, '/([0-9]+)(?:[?#]|$)', 1) AS code, regexp_extract(url, '\?([^#]*)', 1) AS query, url LIKE 'https://%' AS secure FROM pages""",
    "text_filter_cascade": """
SELECT lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents WHERE lower(text) LIKE '%password%' OR lower(text) LIKE '%license%' OR lower(text) LIKE '%token%' GROUP BY 1""",
    "review_reasons": """
SELECT * FROM (SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderpriority LIKE '1%' THEN 'urgent' END, CASE WHEN o_totalprice > 400000 THEN 'large' END, CASE WHEN o_orderstatus = 'P' THEN 'pending' END) AS reasons FROM orders) WHERE reasons <> ''""",
    "doc_findings": """
WITH u AS (SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type = 'purchase') AS bought FROM events GROUP BY 1)
SELECT user_id, 'warning' AS level, 'many errors' AS key FROM u WHERE errors >= 20 UNION ALL SELECT user_id, 'notice', 'some errors' FROM u WHERE errors BETWEEN 15 AND 19
UNION ALL SELECT user_id, 'warning', 'buys little' FROM u WHERE bought * 10 < n""",
    "status_rollup": """
SELECT (SELECT count(*) FROM orders) AS orders, (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) AS last_day, (SELECT count(*) FROM lineitem) AS lines, (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') AS returned,
  (SELECT count(*) FROM events) AS events, (SELECT count(DISTINCT user_id) FROM events) AS users, (SELECT count(*) FROM documents) AS documents, (SELECT CAST(sum(n_chars) AS BIGINT) FROM documents) AS chars""",
    "rollup_counters": "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)",
    "stream_sessions": series.ORACLE_SQL["gap_sessions"],
}
