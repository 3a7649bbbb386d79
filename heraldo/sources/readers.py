"""Readers of the stores that aren't Parquet: JSON documents, keyed state, account lists, exports, screenshots.

All return DataFrames and read with Spark's own sources, so paths may lie in any store that Spark reads.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The styles that an account can be limited to, and what usage headers measure.
FOCUS_STYLES = ("salsa", "bachata", "tango")
USAGE_MEASURES = ("call_count", "total_cputime", "total_time")
APP_HEADER, BUSINESS_HEADER = "X-App-Usage", "X-Business-Use-Case-Usage"
MAX_IMAGES = 10


def json_documents(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The records of JSON documents (an array, or one object per file); none, with the schema, where the path is missing."""
    try:
        return spark.read.schema(schema).json(path, multiLine=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def keyed_state(spark: SparkSession, path: str, record: str, key: str = "id") -> DataFrame:
    """Rows of JSON files that each hold one object from keys to records (a DDL struct). Each file is one row while it
    is parsed; larger state belongs in Parquet tables (operators.state)."""
    whole = spark.read.text(path, wholetext=True)
    pairs = whole.select(F.explode(F.from_json("value", f"map<string,{record}>")).alias(key, "record"))
    return pairs.select(key, "record.*")


def accounts(spark: SparkSession, path: str, styles: tuple[str, ...] = FOCUS_STYLES) -> DataFrame:
    """(account, bar, focus) of an account list: a name per line, with or without @, then `bar` or `solo:style,style`;
    # starts a comment. An unknown word or style fails the read. Of repeated names the last line counts."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("at"), F.regexp_replace("value", "^﻿", "").alias("value"))
    parts = lines.select("at", F.filter(F.split(F.split("value", "#")[0], r"\s+"), lambda w: w != "").alias("words")).where(F.size("words") > 0)
    options = F.slice("words", 2, F.size("words"))
    solo = F.filter(options, lambda w: w.startswith("solo:"))
    focus = F.when(F.size(solo) > 0, F.filter(F.split(F.substring(F.element_at(solo, -1), 6, 1 << 20), ","), lambda s: s != "")).otherwise(F.array().cast("array<string>"))
    known = F.forall(options, lambda w: (w == "bar") | w.startswith("solo:"))
    fits = known & (F.size(F.array_except(focus, F.array(*map(F.lit, styles)))) == 0) & ((F.size(solo) == 0) | (F.size(focus) > 0))
    # the check stands inside a kept column, so that no plan leaves it out
    name = F.when(fits, F.regexp_replace(F.col("words")[0], "^@+", "")).otherwise(F.raise_error(F.concat(F.lit("account list: unknown word in "), F.array_join("words", " "))))
    rows = parts.select(name.alias("account"), F.struct("at", F.array_contains(options, "bar").alias("bar"), focus.alias("focus")).alias("row"))
    return rows.groupBy("account").agg(F.max_by("row", "row.at").alias("row")).select("account", "row.bar", "row.focus")


def latest_posts(posts: DataFrame, n: int, account: str = "account", at: str = "timestamp", tie: str = "id") -> DataFrame:
    """Each account's n newest posts. Spark keeps the first n of each task before it shuffles."""
    rank = F.row_number().over(Window.partitionBy(account).orderBy(F.desc(at), tie))
    return posts.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def following(spark: SparkSession, path: str) -> DataFrame:
    """(position, account) of a follow-list export, HTML or JSON by its content; each account once, at its first place."""
    whole = spark.read.text(path, wholetext=True).select(F.col("value"), F.ltrim("value").rlike(r"^[\[{]").alias("is_json"))
    entry = "array<struct<title:string,string_list_data:array<struct<value:string>>>>"
    wrapped = F.from_json("value", f"relationships_following {entry}")["relationships_following"]
    entries = F.coalesce(F.when(F.ltrim("value").startswith("{"), wrapped), F.from_json("value", entry))
    said = lambda s: F.nullif(s, F.lit(""))
    first_value = lambda e: F.get(F.filter(F.transform(e["string_list_data"], lambda s: said(s["value"])), lambda v: v.isNotNull()), F.lit(0))
    names = F.transform(entries, lambda e: F.coalesce(said(e["title"]), first_value(e)))
    links = F.regexp_extract_all("value", F.lit(r'href="https://www\.instagram\.com/(?:_u/)?([A-Za-z0-9._]+)/?"'), F.lit(1))
    found = F.filter(F.when(F.col("is_json"), names).otherwise(links), lambda n: n.isNotNull())
    return whole.select(F.posexplode(found).alias("position", "account")).groupBy("account").agg(F.min("position").alias("position")).select("position", "account")


def screenshots(spark: SparkSession, folder: str) -> DataFrame:
    """(id, content, name, modified, uploaded): pictures id.jpg with what id.json beside them says; the name is empty
    and the times null where it says nothing or something odd."""
    stem = F.regexp_extract(F.col("path"), r"([^/]+)\.[^./]+$", 1)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").load(folder).select(stem.alias("id"), "content")
    notes = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folder).select(stem.alias("id"), F.col("content").cast("string").alias("note"))
    part = lambda k: F.get_json_object("note", f"$.{k}")
    # a name must be a JSON string; a time must be a whole number
    is_text = F.from_json("note", "map<string,string>")["name"].isNotNull() & F.col("note").rlike(r'"name"\s*:\s*"')
    whole = lambda k: F.when(F.col("note").rlike(rf'"{k}"\s*:\s*-?\d+\s*[,}}]'), part(k).try_cast("long"))
    told = notes.select("id", F.when(is_text, part("name")).alias("name"), whole("modified").alias("modified"), whole("uploaded").alias("uploaded"))
    return files.join(told, "id", "left").withColumn("name", F.coalesce("name", F.lit("")))


def listed(files: DataFrame, most: int) -> DataFrame:
    """(count, more): how many of a store's files there are, up to a limit, and whether more follow."""
    return files.limit(most + 1).agg(F.least(F.count("*"), F.lit(most)).alias("count"), (F.count("*") > most).alias("more"))


def slides(media_type: Column, media_url: Column, thumbnail_url: Column, children: Column) -> Column:
    """array<struct(media_type, image, video)>: the pictures of a post to look at, MAX_IMAGES at most: its slides, or
    itself; of a video its preview frame, and the file behind it."""
    own = F.array(F.struct(media_type.alias("media_type"), media_url.alias("media_url"), thumbnail_url.alias("thumbnail_url")))
    items = F.when(F.size(children) > 0, children).otherwise(own)
    shown = F.transform(
        items,
        lambda m: F.struct(
            m["media_type"].alias("media_type"),
            F.when(m["media_type"] == "IMAGE", m["media_url"]).otherwise(m["thumbnail_url"]).alias("image"),
            F.when(m["media_type"] == "VIDEO", m["media_url"]).alias("video"),
        ),
    )
    return F.slice(F.filter(shown, lambda m: F.coalesce(m["image"], F.lit("")) != ""), 1, MAX_IMAGES)


def usage(app: Column, business: Column) -> Column:
    """map<header, map<measure, percent>>: the highest share a header names of each measure; odd headers are left out."""
    fields = ", ".join(f"{m} double" for m in USAGE_MEASURES)
    struct = "struct<" + ",".join(f"{m}:double" for m in USAGE_MEASURES) + ">"

    def measures(readings: Column) -> Column:
        most = F.map_from_arrays(F.array(*map(F.lit, USAGE_MEASURES)), F.array(*[F.array_max(readings[m]).cast("int") for m in USAGE_MEASURES]))
        return F.map_filter(most, lambda _, v: v.isNotNull())

    by_app = measures(F.array(F.from_json(app, fields)))
    by_business = measures(F.flatten(F.map_values(F.from_json(business, f"map<string,array<{struct}>>"))))
    both = F.map_from_arrays(F.array(F.lit(APP_HEADER), F.lit(BUSINESS_HEADER)), F.array(by_app, by_business))
    return F.map_filter(both, lambda _, v: v.isNotNull() & (F.size(v) > 0))


MODEL = "id string, pricing struct<prompt:string,completion:string>, architecture struct<input_modalities:array<string>,output_modalities:array<string>>, supported_parameters array<string>, context_length long"


def free_vision_models(models: DataFrame) -> DataFrame:
    """(id, structured, json_mode, context) of a listing's MODEL rows that cost nothing, take images and answer in text."""
    free = F.col("id").endswith(":free") | ((F.col("pricing.prompt") == "0") & (F.col("pricing.completion") == "0"))
    outputs = F.coalesce("architecture.output_modalities", F.array(F.lit("text")))
    outputs = F.when(F.size(outputs) == 0, F.array(F.lit("text"))).otherwise(outputs)
    takes = lambda p: F.coalesce(F.array_contains("supported_parameters", p), F.lit(False))
    fits = free & F.array_contains("architecture.input_modalities", "image") & (outputs == F.array(F.lit("text")))
    return models.where(fits).select("id", takes("structured_outputs").alias("structured"), takes("response_format").alias("json_mode"), F.col("context_length").alias("context")).orderBy(F.desc("structured"), "id")
