"""Line deduplication by a deletion-neighbourhood join, with DataFrame functions only.

A line's words (white space collapsed, lower case) are the unit; two lines are near if one word inserted, deleted or
replaced turns one into the other (an edit bound of one word). A non-blank line is removed if an earlier line, by
(doc_id, row, line number), is equal; one of NEAR_WORDS words or more also if an earlier such line is near. Under NEAR_WORDS,
a parameter, one word is more than a fifth of a line: such lines are less than 0.8 alike, and any two of one word would be near.

Equal lines first fall together by their hashes, with a pre-aggregated minimum of their places. Two near lines of
LONG_WORDS words or more agree in their first or in their last ENDS words; distinct lines that share neither with another
need no neighbourhood, and a line that shares one end only can differ by a word at its other end alone. Lines under
LONG_WORDS words travel whole and take all their deletions. The variants with one word deleted there (anywhere, if both
ends are shared) are emitted as hashed keys, beside the line itself; equal keys meet, and the deleted positions and a
second hash verify the edit distance: equal positions are a replacement, and a line met by another's variant lacks one
word. Only the earliest place per key and per (key, position) is needed to decide, so a key that a third of all lines
share is aggregated like any other, and pairs are never listed. Lines are told apart by 96 bits at least, variants by two
64-bit hashes of their words' 64-bit hashes.

Defined cases: a null text stays null and has no lines; blank lines stay; each row is judged by its own text: rows of one
doc_id, or of none, follow each other by a hash of the text (`row`) and lose what one before them holds, and of rows equal in
both any one stays the first (only such rows are numbered and stored); a null doc_id orders first; an empty table gives an empty one; a very long text is split where it stands, its lines being all that is held
apart; columns of any name pass through, as a document's row stays one struct beside what is worked out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import persisted, released, table

NEAR_WORDS, LONG_WORDS = 5, 10
ENDS = LONG_WORDS // 2
PLACE = ["doc_id", "row", "line"]
_BLANK = " \t\x0b\x0c\r"


def _normal(line: Column) -> Column:
    """The line's words with one space between them, in lower case."""
    odd = line.startswith(" ") | line.endswith(" ")
    for space in ("  ", "\t", "\x0b", "\x0c", "\r"):
        odd = odd | line.contains(space)
    return F.lower(F.when(odd, F.btrim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))).otherwise(line))


def _long(normal: Column, least: int) -> Column:
    """Whether there are `least` words or more: something follows the first least - 1."""
    return F.length(F.substring_index(normal, " ", least - 1)) < F.length(normal)


def _keyed(docs: DataFrame) -> DataFrame:
    """(row, doc): each row as a struct beside the hash of its text."""
    return docs.select(F.xxhash64("text").alias("row"), F.struct("*").alias("doc"))


def _marked(rows: DataFrame) -> DataFrame:
    """rows with `again`: whether another row with the same doc_id and text is the first of them."""
    keys = rows.where("doc.text <> ''").groupBy("doc.doc_id", "row").agg(F.count("*").alias("c")).where("c > 1").select(F.col("doc_id").alias("twin_id"), F.col("row").alias("twin"))
    keys = persisted(keys, "equal")
    if not keys.limit(1).count():
        return rows.withColumn("again", F.lit(False))
    fits = F.col("doc.doc_id").eqNullSafe(F.col("twin_id")) & (F.col("row") == F.col("twin"))
    twins = persisted(rows.join(keys, fits, "left_semi").withColumn("number", F.monotonically_increasing_id()), "twins")
    firsts = twins.groupBy("doc.doc_id", "row").agg(F.min("number").alias("first")).select("first")
    marked = twins.join(firsts, F.col("number") == F.col("first"), "left").select("row", "doc", F.col("first").isNull().alias("again"))
    return rows.join(keys, fits, "left_anti").withColumn("again", F.lit(False)).unionByName(marked)


def _lines(rows: DataFrame) -> DataFrame:
    """(doc_id, row, line, words) of the lines that aren't blank; words as one string."""
    lines = rows.select("doc.doc_id", "row", F.posexplode(F.split("doc.text", "\n")).alias("line", "raw")).where(F.col("raw") != "")
    return lines.select("doc_id", "row", "line", _normal(F.col("raw")).alias("words")).where(F.col("words") != "")


def _kept_lines(rows: DataFrame, near: int) -> DataFrame:
    """(doc_id, row, kept): for each text with lines that aren't blank, the numbers of those that stay."""
    words = F.col("words")
    # a line of LONG_WORDS words can be near one with a word less, and shares an end with it
    end = lambda k: F.when(_long(words, LONG_WORDS - 1), F.xxhash64(F.substring_index("words", " ", k), F.lit(k)))
    short = F.when(_long(words, near) & ~_long(words, LONG_WORDS), words)
    keyed = _lines(rows).select(*PLACE, F.xxhash64("words").alias("h1"), F.hash("words").alias("h2"), end(ENDS).alias("head"), end(-ENDS).alias("tail"), short.alias("short"))
    ids = ["h1", "h2", "head", "tail", "short"]
    first = keyed.groupBy(*ids).agg(F.min(F.struct(*PLACE)).alias("place")).select(*ids, "place.*")
    first = persisted(first.drop("h2"), "lines")

    ends = first.where("head is not null").select(F.posexplode(F.array("head", "tail")).alias("kind", "end"), "h1", *PLACE)
    shared = ends.groupBy("end").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low <> high").select("end")
    sharing = lambda kind: F.collect_set(F.when(F.col("kind") == kind, F.col("line")))
    close = ends.join(shared, "end", "left_semi").groupBy("doc_id", "row").agg(sharing(0).alias("heads"), sharing(1).alias("tails"))

    close = close.withColumnsRenamed({"doc_id": "close_id", "row": "close"})
    again = rows.select("row", "doc.doc_id", "doc.text").join(close, F.col("doc_id").eqNullSafe(F.col("close_id")) & (F.col("row") == F.col("close")))
    again = again.select("doc_id", "row", "heads", "tails", F.posexplode(F.split("text", "\n")).alias("line", "raw"))
    again = again.select(*PLACE, "raw", F.array_contains("heads", F.col("line")).alias("by_head"), F.array_contains("tails", F.col("line")).alias("by_tail")).where("by_head or by_tail")
    again = again.select(*PLACE, "by_head", "by_tail", F.split(_normal(F.col("raw")), " ").alias("ws")).withColumn("n", F.size("ws")).where(F.col("n") >= LONG_WORDS)
    long = again.select(F.struct(*PLACE).alias("place"), "ws", "n", F.when(F.col("by_tail"), 0).otherwise(F.col("n") - ENDS).alias("low"), F.when(F.col("by_head"), F.col("n") - 1).otherwise(ENDS - 1).alias("high"))
    whole = first.where("short is not null").select(F.struct(*PLACE).alias("place"), F.split("short", " ").alias("ws")).withColumn("n", F.size("ws"))
    lines = long.unionByName(whole.select("place", "ws", "n", F.lit(0).alias("low"), (F.col("n") - 1).alias("high")))
    hashed = lines.select("place", "n", F.transform("ws", lambda w: F.xxhash64(w)).alias("hs"), F.concat(F.array(F.lit(-1)), F.sequence("low", "high")).alias("gaps"))
    gaps = hashed.select("place", "n", "hs", F.explode("gaps").alias("gap"))
    without = F.when(F.col("gap") < 0, F.col("hs")).otherwise(F.concat(F.expr("slice(hs, 1, greatest(gap, 0))"), F.expr("slice(hs, gap + 2, n)")))
    keys = gaps.select("place", F.col("gap").cast("int").alias("gap"), without.alias("left"))
    variants = persisted(keys.select("place", "gap", F.xxhash64("left").alias("key"), F.xxhash64(F.lit(1), "left").alias("check")), "variants")
    shared_keys = variants.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    together = persisted(variants.join(shared_keys, "key", "left_semi"), "together")
    released(variants)
    of_key = together.groupBy("key", "check").agg(F.min("place").alias("any"), F.min(F.when(F.col("gap") < 0, F.col("place"))).alias("whole"))
    of_gap = together.groupBy("key", "check", "gap").agg(F.min("place").alias("same"))
    # the line itself meets every variant; a variant meets the line without its word, and variants that lack the same word
    earlier = F.when(F.col("gap") < 0, F.col("any")).otherwise(F.least("whole", "same"))
    near_lines = together.join(of_key, ["key", "check"]).join(of_gap, ["key", "check", "gap"]).where(earlier < F.col("place")).select("place").distinct()
    near_lines = near_lines.select(*[F.col(f"place.{c}").alias(f"near_{c}") for c in PLACE])
    stays = first.join(near_lines, F.col("doc_id").eqNullSafe(F.col("near_doc_id")) & (F.col("row") == F.col("near_row")) & (F.col("line") == F.col("near_line")), "left_anti")
    return stays.groupBy("doc_id", "row").agg(F.collect_set("line").alias("kept"))


def deduplicated(docs: DataFrame, near: int = NEAR_WORDS) -> DataFrame:
    """(doc, n_lines, n_removed): the rows of docs as structs, text without the removed lines, and counts of lines (long)."""
    keyed = _keyed(docs)
    kept = _kept_lines(keyed, near).withColumnsRenamed({"doc_id": "kept_id", "row": "kept_row"})
    rows = _marked(keyed).join(kept, F.col("doc.doc_id").eqNullSafe(F.col("kept_id")) & (F.col("row") == F.col("kept_row")), "left").withColumn("parts", F.split("doc.text", "\n"))
    rows = rows.withColumn("kept", F.when(~F.col("again"), F.col("kept")))
    stays = lambda x, i: F.coalesce(F.array_contains("kept", i), F.lit(False)) | (F.btrim(x, F.lit(_BLANK)) == "")
    rows = rows.select("doc", F.size("parts").alias("n"), F.filter("parts", stays).alias("lines"))
    some = F.col("doc.text").isNotNull()
    return rows.select(
        F.col("doc").withField("text", F.when(some, F.array_join("lines", "\n"))).alias("doc"),
        F.when(some, F.col("n")).otherwise(0).cast("long").alias("n_lines"), F.when(some, F.col("n") - F.size("lines")).otherwise(0).cast("long").alias("n_removed"),
    )


def filter_documents(docs: DataFrame) -> DataFrame:
    """docs with the removed lines taken out; documents that lost lines and have no word left go. n_chars follows the text."""
    out = deduplicated(docs).where((F.col("n_removed") == 0) | (F.btrim(F.col("doc.text"), F.lit(_BLANK + "\n")) != "")).select("doc.*")
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc.*", "n_lines", "n_removed")
    return out.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("text_chars"), F.sha2("text", 256).alias("text_sha256"))


OP10_SQL = r"""
WITH l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS raw FROM documents),
w AS (SELECT doc_id, i, raw, doc_id * 1000000 + i AS place,
        list_filter(regexp_split_to_array(lower(raw), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM l),
f AS (SELECT ws, min(place) AS place FROM w WHERE len(ws) > 0 GROUP BY ws),
v AS (SELECT place, 0 AS gap, array_to_string(ws, ' ') AS k FROM f WHERE len(ws) >= 5 UNION ALL
      SELECT place, g, array_to_string(list_concat(list_slice(ws, 1, g - 1), list_slice(ws, g + 1, len(ws))), ' ') FROM (SELECT place, ws, unnest(range(1, len(ws) + 1)) AS g FROM f WHERE len(ws) >= 5)),
n AS (SELECT DISTINCT b.place FROM v a JOIN v b ON a.k = b.k AND a.place < b.place AND (a.gap = b.gap OR a.gap = 0 OR b.gap = 0)),
s AS (SELECT place FROM f EXCEPT SELECT place FROM n),
r AS (SELECT w.doc_id, w.i, w.raw, len(ws) = 0 OR s.place IS NOT NULL AS stays FROM w LEFT JOIN s ON s.place = w.place),
g AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_removed, coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (stays), '') AS t FROM r GROUP BY 1)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed, CAST(length(t) AS BIGINT) AS text_chars, sha256(t) AS text_sha256 FROM g
"""
