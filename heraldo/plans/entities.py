"""Queries on matching, and on the upkeep of keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heraldo.operators import matching, state
from heraldo.sources.tables import table


def overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.to_date("o_orderdate")
    spans = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", first.alias("first"), F.date_add(first, (F.col("o_orderkey") % 7).cast("int")).alias("last"))
    return matching.overlapping(spans, "o_orderkey", "o_custkey", "first", "last")


def session_set_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").where("event_type = 'purchase'").select("user_id", F.to_date("ts").alias("day"))
    return matching.shared_members(days, "user_id", "day", share=0.5, sizes=False)


def rule_priority_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = F.when(F.col("o_orderpriority").startswith("1"), 1).when(F.col("o_orderstatus") == "O", 2).when(F.col("o_totalprice") > 200000, 3).otherwise(4)
    candidates = table(spark, sf_dir, "orders").select("o_custkey", rule.alias("rule"), "o_orderkey")
    best = matching.by_priority(candidates, "o_custkey", ["rule", "o_orderkey"])
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey")).join(best, "o_custkey", "left")


def dedupe_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", F.sha2(F.lower(F.trim("text")), 256).alias("mark"))
    return matching.keep_richest(docs, F.col("mark"), "doc_id", [F.col("n_chars")])


def possible_twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.first_twin(table(spark, sf_dir, "part"), ["p_brand", "p_type"], "p_partkey", F.split("p_name", " "))


def title_word_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").groupBy("p_name").agg(F.count("*").alias("parts"))
    words = names.select("p_name", F.explode(F.split("p_name", " ")).alias("word"))
    out = matching.shared_members(words, "p_name", "word")
    return out.select("a", "b", "shared", (F.col("shared") >= 0.5 * F.least("na", "nb")).alias("half"), ((F.col("shared") >= 2) & (F.col("shared") >= 0.6 * F.least("na", "nb"))).alias("same_title"))


def near_dup_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashes = table(spark, sf_dir, "embeddings").select("vec_id", "label", matching.sign_bits("embedding").alias("bits"))
    return matching.close_hashes(hashes, "vec_id", "label", "bits", 20)


def gold_match_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    def grams(name: str, key: str) -> DataFrame:
        words = table(spark, sf_dir, name).select(key, F.split(F.lower("text"), r"[^a-z0-9]+").alias("w"))
        return words.where(F.size("w") >= 5).select(key, F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 4), lambda i: F.xxhash64(F.slice("w", i, 5)))).alias("gram"))

    return matching.best_overlap(grams("benchmark", "item_id"), grams("documents", "doc_id"), "item_id", "doc_id", "gram")


def gold_match_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").alias("item")).agg(F.max("l_quantity").alias("want"))
    answers = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("answer"), F.col("l_quantity").alias("have")).groupBy("l_orderkey", "answer").agg(F.max("have").alias("have"))
    pairs = lines.join(answers, "l_orderkey").where(F.abs(F.col("want") - F.col("have")) <= 10).select("l_orderkey", "item", "answer", (-F.abs(F.col("want") - F.col("have"))).alias("score"))
    return matching.greedy_claims(pairs, "l_orderkey", "item", "answer", "score")


def merge_first_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.struct("o_orderdate", "o_orderkey")
    priority = F.when(~F.col("o_orderpriority").startswith("4"), F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(state.first_known(priority, at).alias("priority"), state.newest_known(F.col("o_totalprice"), at).alias("price"), F.to_date(F.max("o_orderdate")).alias("day"))


def cdc_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", state.digest(F.col("text"), 16).alias("mark"))
    stored = table(spark, sf_dir, "labels").select("doc_id").distinct().join(docs, "doc_id").select("doc_id", state.digest(F.trim("text"), 16).alias("mark"))
    gone = table(spark, sf_dir, "labels").where("toxic = 1").select((-F.col("doc_id") - 1).alias("doc_id"), F.lit("").alias("mark"))
    return state.actions(docs, stored.unionByName(gone), "doc_id", "mark")


def detach_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag"))).alias("media"))
    left = state.detached(lines, "media", keep=lambda m: m["l_returnflag"] != "R")
    return left.select("l_orderkey", F.size("media").cast("long").alias("n"), F.array_join(F.transform("media", lambda m: m["l_linenumber"].cast("string")), ",").alias("lines"))


def tombstone_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    hidden = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return state.without(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), hidden, ["o_custkey"])


def retention_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = state.retained(table(spark, sf_dir, "orders"), "o_orderdate", F.lit("1998-06-01").cast("timestamp_ntz"))
    return out.groupBy(F.year("o_orderdate").alias("year"), "kept").agg(F.count("*").alias("n"))


def archive_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), "o_custkey", "o_orderdate", "o_orderkey")
    return state.latest(rows, ["year", "o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


def upsert_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderkey")
    return state.upsert(orders.where("day < date'1998-01-01'"), orders.where("day >= date'1998-01-01'"), ["o_custkey"], ["day", "o_orderkey"])


def gc_unreferenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return state.unreferenced(table(spark, sf_dir, "orders").select("o_orderkey"), refs, "o_orderkey")


def fingerprint_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "nation").select("n_regionkey", "n_name").join(table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name"), "n_regionkey")
    return state.fingerprint(names, F.concat_ws("/", "r_name", "n_name"))


def unique_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    slug = F.regexp_replace(F.lower(F.concat_ws(" ", "p_name", "p_type")), "[^a-z0-9]+", "-")
    return state.numbered_ids(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type"), slug, ["p_partkey"]).select("p_partkey", "id")


def failure_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").cast("int").alias("misses"), F.bool_or((F.col("event_type") == "signup") & (F.col("value") > 150)).alias("found"))
    out = users.withColumn("s", state.give_up(F.col("misses"), F.col("found"), 15))
    return out.select("user_id", "s.misses", "s.given_up")


QUERIES = {f.__name__: f for f in (overlap_pairs, session_set_overlap, rule_priority_match, dedupe_documents, possible_twins, title_word_overlap, near_dup_hamming, gold_match_best, gold_match_greedy, merge_first_last, cdc_actions, detach_media, tombstone_antijoin, retention_split, archive_by_year, upsert_state, gc_unreferenced, fingerprint_set, unique_ids, failure_counters)}

_GRAMS = """SELECT DISTINCT {key}, array_to_string(list_slice(w, i, i + 4), ' ') AS gram FROM (SELECT {key}, w, unnest(range(1, len(w) - 3)) AS i FROM (SELECT {key}, regexp_split_to_array(lower(text), '[^a-z0-9]+') AS w FROM {name}) WHERE len(w) >= 5)"""

ORACLE_SQL = {
    "overlap_pairs": """
WITH s AS (SELECT o_orderkey AS k, o_custkey, CAST(o_orderdate AS DATE) AS f, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 7 AS INTEGER) AS l FROM orders)
SELECT x.k AS a, y.k AS b, x.o_custkey FROM s x JOIN s y ON x.o_custkey = y.o_custkey AND x.k < y.k AND x.f <= y.l AND y.f <= x.l""",
    "session_set_overlap": """
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase'), n AS (SELECT user_id, count(*) AS n FROM d GROUP BY 1),
p AS (SELECT x.user_id AS a, y.user_id AS b, count(*) AS shared FROM d x JOIN d y ON x.day = y.day AND x.user_id < y.user_id GROUP BY 1, 2)
SELECT a, b, shared FROM p JOIN n x ON x.user_id = a JOIN n y ON y.user_id = b WHERE 2 * shared >= least(x.n, y.n)""",
    "rule_priority_match": """
WITH c AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 1 WHEN o_orderstatus = 'O' THEN 2 WHEN o_totalprice > 200000 THEN 3 ELSE 4 END AS rule FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY rule, o_orderkey) AS k FROM c)
SELECT c_custkey AS o_custkey, rule, o_orderkey FROM customer LEFT JOIN r ON o_custkey = c_custkey AND k = 1""",
    "dedupe_documents": """
WITH r AS (SELECT doc_id, row_number() OVER w AS k, first_value(doc_id) OVER w AS kept FROM documents WINDOW w AS (PARTITION BY lower(trim(text)) ORDER BY n_chars DESC, doc_id))
SELECT kept, doc_id AS dropped FROM r WHERE k > 1""",
    "possible_twins": """
WITH w AS (SELECT DISTINCT p_brand, p_type, p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)
SELECT x.p_partkey, min(y.p_partkey) AS twin FROM w x JOIN w y ON x.p_brand = y.p_brand AND x.p_type = y.p_type AND x.word = y.word AND x.p_partkey <> y.p_partkey GROUP BY 1""",
    "title_word_overlap": """
WITH w AS (SELECT DISTINCT p_name, unnest(string_split(p_name, ' ')) AS word FROM part), n AS (SELECT p_name, count(*) AS n FROM w GROUP BY 1),
p AS (SELECT x.p_name AS a, y.p_name AS b, count(*) AS shared FROM w x JOIN w y ON x.word = y.word AND x.p_name < y.p_name GROUP BY 1, 2)
SELECT a, b, shared, shared >= 0.5 * least(x.n, y.n) AS half, shared >= 2 AND shared >= 0.6 * least(x.n, y.n) AS same_title FROM p JOIN n x ON x.p_name = a JOIN n y ON y.p_name = b""",
    "near_dup_hamming": """
WITH b AS (SELECT vec_id, label, list_transform(range(1, 65), lambda i: CASE WHEN embedding[i] > 0 THEN 1 ELSE 0 END) AS s FROM embeddings),
p AS (SELECT x.vec_id AS a, y.vec_id AS b, CAST(list_sum(list_transform(range(1, 65), lambda i: CASE WHEN x.s[i] = y.s[i] THEN 0 ELSE 1 END)) AS BIGINT) AS distance FROM b x JOIN b y ON x.label = y.label AND x.vec_id < y.vec_id)
SELECT * FROM p WHERE distance <= 20""",
    "gold_match_best": f"""
WITH i AS ({_GRAMS.format(key="item_id", name="benchmark")}), d AS ({_GRAMS.format(key="doc_id", name="documents")}),
p AS (SELECT item_id, doc_id, count(*) AS shared FROM i JOIN d USING (gram) GROUP BY 1, 2)
SELECT item_id, doc_id, shared FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY shared DESC, doc_id) AS k FROM p) WHERE k = 1""",
    "merge_first_last": """
SELECT o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) FILTER (o_orderpriority NOT LIKE '4%') AS priority, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS price, CAST(max(o_orderdate) AS DATE) AS day FROM orders GROUP BY 1""",
    "cdc_actions": """
WITH s AS (SELECT DISTINCT d.doc_id, sha256(trim(text)) AS mark FROM labels l JOIN documents d ON d.doc_id = l.doc_id UNION ALL SELECT -doc_id - 1, '' FROM labels WHERE toxic = 1),
f AS (SELECT coalesce(d.doc_id, s.doc_id) AS doc_id, d.doc_id AS here, s.doc_id AS there, sha256(text) AS now, mark FROM documents d FULL JOIN s ON s.doc_id = d.doc_id)
SELECT doc_id, CASE WHEN there IS NULL THEN 'new' WHEN here IS NULL THEN 'missing' WHEN now IS NOT DISTINCT FROM mark THEN 'unchanged' ELSE 'changed' END AS action FROM f""",
    "detach_media": """
SELECT l_orderkey, count(*) AS n, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS lines FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1""",
    "tombstone_antijoin": "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal < 0)",
    "retention_split": "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderdate >= TIMESTAMP '1998-06-01' AS kept, count(*) AS n FROM orders GROUP BY 1, 2",
    "archive_by_year": "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1, 2",
    "upsert_state": """
SELECT o_custkey, day, o_orderkey FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1""",
    "gc_unreferenced": "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    "fingerprint_set": "SELECT sha256(string_agg(k, chr(10) ORDER BY k)) AS fingerprint FROM (SELECT DISTINCT r_name || '/' || n_name AS k FROM nation JOIN region ON r_regionkey = n_regionkey)",
    "unique_ids": """
WITH s AS (SELECT p_partkey, regexp_replace(lower(p_name || ' ' || p_type), '[^a-z0-9]+', '-', 'g') AS base FROM part),
n AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY p_partkey) AS k FROM s)
SELECT p_partkey, CASE WHEN k = 1 THEN base ELSE base || '-' || k END AS id FROM n""",
    "failure_counters": """
WITH u AS (SELECT user_id, CAST(count(*) FILTER (event_type = 'error') AS INTEGER) AS misses, bool_or(event_type = 'signup' AND value > 150) AS found FROM events GROUP BY 1),
n AS (SELECT user_id, CASE WHEN found THEN 0 ELSE misses + 1 END AS misses FROM u)
SELECT user_id, misses, misses >= 15 AS given_up FROM n""",
}
