"""Queries that answer why a post is shown or not, which event a reading is, and what a page holds, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heraldo.operators import diagnosis, rereads
from heraldo.sources import pages
from heraldo.sources.tables import table


def post_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a link to a post of its customer: a third have a record, others were looked up in their account's posts."""
    k, none = F.col("o_orderkey"), F.lit(None).cast("string")
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    at = lambda day, hour: F.make_timestamp(F.year(day), F.month(day), F.day(day), hour.cast("int"), F.lit(0), F.lit(0), F.lit("UTC"))
    link = lambda c: F.concat(F.lit("https://red.example/p/"), c.cast("string"), F.lit("/"))
    name = lambda c: F.concat(F.lit("c"), c.cast("string"))
    asked = orders.select(
        k.alias("post"),
        F.when(k % 29 == 0, "https://red.example/about").when(k % 5 == 0, F.concat(F.lit("https://red.example/C"), F.col("o_custkey").cast("string"), F.lit("/p/"), k.cast("string"))).otherwise(link(k)).alias("link"),
        F.when((k % 5).isin(1, 2, 3), name(F.col("o_custkey"))).alias("account"), F.when(k % 7 == 0, name(F.col("o_custkey") + 1)).alias("author"),
    )
    outcomes = F.array(*map(F.lit, ["event", "merged", "discarded", "hidden", "rejected", "not_event", "not_event"]))
    reason = F.when(k % 8 == 6, F.concat(F.lit(f"{diagnosis.REMOVED_BY_HAND}: "), F.col("o_orderstatus"))).otherwise(F.col("o_orderpriority"))
    records = orders.where(k % 3 == 0).select(
        name(F.col("o_custkey")).alias("account"), link(k).alias("permalink"), F.when(k % 8 > 0, F.element_at(outcomes, (k % 8).cast("int"))).alias("outcome"),
        F.when(k % 2 > 0, F.concat_ws(", ", F.col("o_orderstatus"), F.col("o_orderpriority"))).alias("detail"), reason.alias("reason"), none.alias("model"), (k % 9 == 0).alias("provisional"),
        at(F.col("o_orderdate"), F.lit(0)).alias("processed_at"), F.when((k % 8).isin(1, 2), F.array(k, F.floor(k / 2))).alias("event_ids"), (k % 16 == 0).alias("is_event_post"),
    )
    events = orders.where(k % 4 < 2).select(k.alias("id"), F.col("o_orderstatus").alias("title"), F.to_date("o_orderdate").alias("last_day"), F.array(link(k), link(k * 2)).alias("permalinks"))
    c = F.col("c_custkey")
    account = name(c).alias("account")
    followed = customers.where(c % 6 != 0).select(account)
    feeds = customers.where(c % 11 != 0).select(account, F.when(c % 13 == 0, "private").when(c % 17 == 0, "busy").alias("problem"))
    feed = orders.where(k % 10 != 0).select(name(F.col("o_custkey")).alias("account"), link(k).alias("permalink"), at(F.col("o_orderdate"), k % 24).alias("published"))
    first = F.date_sub(F.lit("1998-01-01").cast("date"), (c * 37 % 2000).cast("int"))
    states = customers.where(c % 9 != 0).select(account, first.alias("first_seen"), F.when(c % 4 > 0, at(F.lit("1998-07-01").cast("date"), c % 4)).alias("last_read"))
    day = F.lit("1998-07-29").cast("date")
    runs = customers.select(at(day, c % 24).alias("finished_at"), (c % 2 == 1).alias("pending"))
    tries = orders.select(name(F.col("o_custkey")).alias("account"), at(F.col("o_orderdate"), k % 24).alias("finished_at"), (k % 3 == 1).alias("failed"))
    now = F.make_timestamp(F.lit(1998), F.lit(8), F.lit(3), F.lit(0), F.lit(0), F.lit(0), F.lit("UTC"))
    found = diagnosis.diagnose(asked, records, events, followed, feeds, feed, states, runs, tries, now, F.lit("1996-01-01").cast("date"), "UTC", 900, 1500)
    checks = F.array_join(F.transform("checks", lambda x: F.concat(x["mark"], F.lit(":"), x["check"])), ",")
    return found.select("post", "of_account", "verdict", "add", checks.alias("checks"), F.array_join("details", "|").alias("details"), F.array_join(F.transform("shown", lambda e: e["id"]), ",").alias("shown"))


def reread_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's orders as a post's new readings; most are also events it announced before, in reverse, some of them since changed."""
    k, none = F.col("o_orderkey"), F.lit(None).cast("string")
    orders = table(spark, sf_dir, "orders")
    year = F.to_date(F.date_trunc("year", "o_orderdate"))
    kind = F.when(k % 2 == 0, "social").alias("event_type")
    readings = orders.select(F.col("o_custkey").alias("post"), k.alias("pos"), year.alias("date"), F.col("o_orderstatus").alias("title"), F.when(k % 3 == 1, "20:00").when(k % 3 == 2, "21:00").alias("start_time"), kind)
    events = orders.where(k % 5 > 0).select(
        F.col("o_custkey").alias("post"), (-k).alias("pos"), k.alias("id"), F.when(k % 4 > 0, year).alias("date"), F.when(k % 7 == 0, none).otherwise(F.lower("o_orderstatus")).alias("title"),
        F.when(k % 3 == 1, F.when(F.col("o_custkey") % 2 == 0, "20:00").otherwise("21:00")).alias("start_time"), kind,
    )
    return rereads.kept_ids(readings, events, "post", "pos", "id")


def embedded_post(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a post's: a third hold it as data, whole html and all, a third in their markup only, a third as data cut off; some hold none."""
    k, html = F.col("page_id"), F.col("html")
    title = F.translate(F.regexp_extract(html, "(?s)<title>(.*?)</title>", 1), "&", "")
    author = F.when(k % 20 == 7, "a b").otherwise(F.concat(F.lit("Site_"), (k % 50).cast("string")))
    file = lambda ending: F.concat(F.lit("https://x/"), k.cast("string"), F.lit(ending))
    node = lambda video: [(F.lit(True) if video else F.lit(False)).alias("is_video"), file(".jpg").alias("display_url"), file(".mp4").alias("video_url")]
    slide = lambda video: F.struct(F.struct(*node(video)).alias("node"))
    kind = F.element_at(F.array(*map(F.lit, ["GraphImage", "GraphVideo", "GraphSidecar", "Odd"])), (k % 4 + 1).cast("int"))
    media = F.struct(
        kind.alias("__typename"), F.struct(author.alias("username")).alias("owner"), k.cast("string").alias("id"), (k * 1000).alias("taken_at_timestamp"), (k % 4 == 1).alias("is_video"), *node(False)[1:],
        F.struct(F.array(F.struct(F.struct(html.alias("text")).alias("node"))).alias("edges")).alias("edge_media_to_caption"), F.struct(F.array(slide(True), slide(False)).alias("edges")).alias("edge_sidecar_to_children"),
    )
    text = F.to_json(F.struct(F.to_json(F.struct(F.struct(media.alias("shortcode_media")).alias("gql_data"))).alias("v")))
    raw = F.substring(text, F.lit(7), F.length(text) - 8 - (k % 3 == 2).cast("int"))
    script = F.when(k % 3 != 1, F.concat(F.lit(f"<script>s({{{pages.CONTEXT}"), raw, F.lit('","z":1})</script>')))
    shown = F.concat(
        F.lit('<b class="UsernameText">'), author, F.lit('</b><img class="EmbeddedMediaImage" src="'), file("m.jpg?a=1&amp;b=2"), F.lit('"><div class="Caption"><a>'), author, F.lit("</a> "), title,
        F.lit(' &amp; m&aacute;s<br/><i>ya</i> <div class="CaptionComments"></div></div>'),
    )
    page = F.when(k % 33 == 5, html).otherwise(F.concat(F.coalesce(script, F.lit("")), shown))
    found = pages.posts(table(spark, sf_dir, "pages").select("page_id", page.alias("page")), "page")
    files = F.array_join(F.transform("media", lambda m: F.concat_ws(" ", m["media_type"], m["image"], m["video"])), ",")
    return found.select("page_id", "author", "id", "media_type", F.sha2("caption", 256).alias("caption_sha256"), "taken_at", files.alias("media"), "by_data", "refused")


QUERIES = {f.__name__: f for f in (post_diagnosis, reread_ids, embedded_post)}

ORACLE_SQL = {
    "post_diagnosis": """
WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, o_orderpriority AS p, CAST(o_orderdate AS DATE) AS d, o_orderkey % 3 = 0 AND o_orderkey % 29 > 0 AS seen FROM orders),
r AS (SELECT *, CASE k % 8 WHEN 0 THEN CASE WHEN k % 16 = 0 THEN 'event' ELSE 'not_event' END WHEN 1 THEN 'event' WHEN 2 THEN 'merged' WHEN 3 THEN 'discarded' WHEN 4 THEN 'hidden' WHEN 5 THEN 'rejected' ELSE 'not_event' END AS outcome FROM o WHERE seen),
e AS (SELECT k AS id, d AS last_day FROM o WHERE k % 4 < 2),
ids AS (SELECT k, k AS id FROM r WHERE k % 8 IN (1, 2) OR k % 16 = 0 UNION SELECT k, k // 2 FROM r WHERE k % 8 IN (1, 2) OR k % 16 = 0),
st AS (SELECT ids.k, count(*) AS n, count(*) FILTER (last_day >= DATE '1996-01-01') AS up, string_agg(CAST(id AS VARCHAR), ',' ORDER BY last_day, CAST(id AS VARCHAR)) FILTER (last_day >= DATE '1996-01-01') AS shown FROM ids JOIN e USING (id) GROUP BY 1),
t AS (SELECT c, arg_max(k % 3 = 1, row(d + to_hours(CAST(k % 24 AS INTEGER)), k % 3 = 1)) AS failed FROM o GROUP BY 1),
l AS (SELECT max(row(c_custkey % 24, c_custkey % 2 = 1)) AS m FROM customer),
q AS (SELECT o.*, outcome, st.n, coalesce(up, 0) AS up, shown, CASE WHEN k % 29 = 0 THEN NULL ELSE k END AS code, CASE WHEN k % 5 IN (1, 2, 3) OR (k % 5 = 0 AND k % 29 > 0) THEN c END AS named, CASE WHEN k % 7 = 0 THEN c + 1 END AS author FROM o LEFT JOIN (SELECT k, outcome FROM r) USING (k) LEFT JOIN st USING (k)),
a AS (SELECT *, CASE WHEN seen THEN c ELSE coalesce(author, named) END AS acc, NOT seen AND coalesce(author <> named, false) AS collab FROM q),
w AS (SELECT a.*, cu.c_custkey % 6 > 0 AS known, cu.c_custkey % 11 > 0 AS looked, CASE WHEN acc % 11 > 0 THEN CASE WHEN acc % 13 = 0 THEN 'private' WHEN acc % 17 = 0 THEN 'busy' END END AS problem,
    CASE WHEN acc = a.c AND k % 10 > 0 AND code IS NOT NULL THEN d + to_hours(CAST(k % 24 AS INTEGER)) END AS pub, CASE WHEN cu.c_custkey % 9 > 0 THEN DATE '1998-01-01' - CAST(acc * 37 % 2000 AS INTEGER) END AS first,
    CASE WHEN cu.c_custkey % 9 > 0 AND acc % 4 > 0 THEN TIMESTAMP '1998-07-01' + to_hours(CAST(acc % 4 AS INTEGER)) ELSE TIMESTAMP '1998-07-29' + to_hours(CAST(m[1] AS INTEGER)) END AS read, t.failed, m[2] AS pending
  FROM a CROSS JOIN l LEFT JOIN customer cu ON c_custkey = acc LEFT JOIN t ON t.c = acc),
v AS (SELECT *, CASE WHEN code IS NULL THEN 'not_a_post' WHEN seen AND outcome IN ('event', 'merged') THEN CASE WHEN up > 0 THEN 'shown' WHEN n > 0 THEN 'over' ELSE 'gone' END
    WHEN seen AND outcome IN ('discarded', 'hidden', 'rejected') THEN outcome WHEN seen THEN CASE WHEN k % 8 = 6 THEN 'removed' ELSE 'not_event' END
    WHEN acc IS NULL THEN 'unknown_account' WHEN NOT coalesce(known, false) THEN 'not_followed' WHEN NOT looked THEN 'not_looked_up' WHEN problem = 'private' THEN 'private' WHEN problem IS NOT NULL THEN 'unreadable'
    WHEN pub IS NULL THEN 'not_in_feed' WHEN first IS NULL THEN 'new_account' WHEN pub > read THEN 'after_last_read' WHEN pub < first AND pub < TIMESTAMP '1998-08-03' - INTERVAL 1500 DAY THEN 'before_first_read'
    WHEN pub < TIMESTAMP '1998-08-03' - INTERVAL 900 DAY THEN 'too_old' WHEN failed THEN 'last_read_failed' WHEN pending THEN 'waiting' ELSE 'unexplained' END AS verdict, coalesce(known, false) AS fol FROM w)
SELECT k AS post, 'c' || acc AS of_account, verdict, verdict NOT IN ('not_a_post', 'shown', 'over', 'removed', 'unknown_account', 'private', 'unreadable', 'not_in_feed') AS add,
  CASE WHEN code IS NULL THEN '' ELSE concat_ws(',', CASE WHEN NOT seen AND acc IS NULL THEN 'info:no_record' END, CASE WHEN collab THEN 'info:collaboration' END, CASE WHEN acc IS NOT NULL THEN CASE WHEN fol THEN 'ok' ELSE 'no' END || ':followed' END,
    CASE WHEN seen THEN CASE WHEN k % 9 = 0 THEN 'ok:analyzed_for_now' ELSE 'ok:analyzed' END END, CASE WHEN verdict = 'shown' THEN CASE WHEN outcome = 'merged' THEN 'ok:joined_events' ELSE 'ok:became_events' END END,
    CASE WHEN verdict = 'over' THEN 'info:over' WHEN seen AND verdict <> 'shown' THEN 'no:' || verdict END, CASE WHEN NOT seen AND fol THEN 'info:not_analyzed' END,
    CASE WHEN verdict IN ('private', 'unreadable', 'not_in_feed') THEN 'no:' || verdict END, CASE WHEN NOT seen AND fol AND looked AND problem IS NULL AND pub IS NOT NULL THEN 'ok:published' END) END AS checks,
  CASE verdict WHEN 'discarded' THEN CASE WHEN k % 2 > 0 THEN s || '|' || p ELSE 'no era publicable' END WHEN 'rejected' THEN p WHEN 'not_event' THEN p WHEN 'removed' THEN s WHEN 'unreadable' THEN problem ELSE '' END AS details,
  coalesce(CASE WHEN seen THEN shown END, '') AS shown
FROM v""",
    "reread_ids": """
WITH RECURSIVE r AS (SELECT o_custkey AS post, o_orderkey AS pos, CAST(date_trunc('year', o_orderdate) AS DATE) AS date, lower(o_orderstatus) AS title, CASE o_orderkey % 3 WHEN 1 THEN '20:00' WHEN 2 THEN '21:00' END AS start, o_orderkey % 2 AS type FROM orders),
e AS (SELECT o_custkey AS post, o_orderkey AS pos, o_orderkey AS id, CASE WHEN o_orderkey % 4 > 0 THEN CAST(date_trunc('year', o_orderdate) AS DATE) END AS date, CASE WHEN o_orderkey % 7 > 0 THEN lower(o_orderstatus) END AS title,
    CASE WHEN o_orderkey % 3 = 1 THEN CASE WHEN o_custkey % 2 = 0 THEN '20:00' ELSE '21:00' END END AS start, o_orderkey % 2 AS type FROM orders WHERE o_orderkey % 5 > 0),
f AS (SELECT r.post, r.pos, e.pos AS spot, e.id, CASE WHEN e.date IS NOT DISTINCT FROM r.date THEN 8 ELSE 0 END + CASE WHEN e.title = r.title THEN 4 ELSE 0 END + CASE WHEN e.start = r.start THEN 2 ELSE 0 END + CASE WHEN e.type = r.type THEN 1 ELSE 0 END AS fit
  FROM r LEFT JOIN e USING (post)),
q AS (SELECT post, pos, list({'f': -fit, 'p': -spot, 'id': id}) AS offers, row_number() OVER (PARTITION BY post ORDER BY max(CASE WHEN id IS NULL THEN 0 ELSE fit END) DESC, pos) AS n FROM f GROUP BY 1, 2),
s AS (SELECT DISTINCT post, 0::BIGINT AS n, CAST([] AS BIGINT[]) AS taken, NULL::BIGINT AS pos, NULL::BIGINT AS id FROM r
  UNION ALL SELECT post, n, CASE WHEN pick IS NULL THEN taken ELSE list_append(taken, pick) END, pos, pick FROM (
    SELECT s.post, q.n, s.taken, q.pos, list_sort(list_filter(q.offers, lambda x: x.id IS NOT NULL AND NOT list_contains(s.taken, x.id)))[1].id AS pick FROM s JOIN q ON q.post = s.post AND q.n = s.n + 1))
SELECT post, pos, id FROM s WHERE n > 0""",
    "embedded_post": """
WITH p AS (SELECT page_id AS k, html, replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '&', '') AS title, page_id % 33 = 5 AS bare, page_id % 20 = 7 AND page_id % 33 <> 5 AS odd, page_id % 3 = 0 AS data FROM pages),
f AS (SELECT *, NOT bare AND NOT odd AS ok, 'https://x/' || k AS file FROM p)
SELECT k AS page_id, CASE WHEN ok THEN 'site_' || (k % 50) END AS author, CASE WHEN ok AND data THEN CAST(k AS VARCHAR) END AS id,
  CASE WHEN ok THEN CASE WHEN NOT data THEN 'IMAGE' WHEN k % 4 = 1 THEN 'VIDEO' WHEN k % 4 = 2 THEN 'CAROUSEL_ALBUM' ELSE 'IMAGE' END END AS media_type,
  CASE WHEN ok THEN sha256(CASE WHEN data THEN html ELSE regexp_replace(title || ' & más' || chr(10) || 'ya', '^\\s+', '') END) END AS caption_sha256, CASE WHEN ok AND data THEN k * 1000 END AS taken_at,
  CASE WHEN NOT ok THEN NULL WHEN NOT data THEN 'IMAGE ' || file || 'm.jpg?a=1&b=2' WHEN k % 4 = 1 THEN 'VIDEO ' || file || '.jpg ' || file || '.mp4'
    WHEN k % 4 = 2 THEN 'VIDEO ' || file || '.jpg ' || file || '.mp4,IMAGE ' || file || '.jpg' ELSE 'IMAGE ' || file || '.jpg' END AS media,
  CASE WHEN ok THEN data END AS by_data, CASE WHEN bare THEN 'no post' WHEN odd THEN 'odd author' END AS refused
FROM f""",
}
