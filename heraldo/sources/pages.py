"""A post read from its public page: from the data that the page embeds as JSON within a JSON string, else from its markup."""

from __future__ import annotations

import html as entities

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# What the page's data and markup are called.
CONTEXT = '"contextJSON":"'
MEDIA = "$.gql_data.shortcode_media"
MEDIA_TYPES = {"GraphVideo": "VIDEO", "GraphSidecar": "CAROUSEL_ALBUM", "GraphImage": "IMAGE"}
AUTHOR = 'class="UsernameText">([^<]+)<'
IMAGE = 'class="EmbeddedMediaImage"[^>]*?src="([^"]+)"'
CAPTION = ('<div class="Caption">', '<div class="CaptionComments">')
ACCOUNT = r"^@?([A-Za-z0-9._]{1,30})$"

NO_POST, ODD_AUTHOR = "no post", "odd author"


@F.pandas_udf(StringType())
def unescaped(text: pd.Series) -> pd.Series:
    """Text with all of HTML's entities decoded."""
    return text.map(entities.unescape, na_action="ignore")


def between(text: Column, start: str, end: str) -> Column:
    """What stands between the first `start` and the next `end`; null without either."""
    rest = F.when(F.instr(text, start) > 0, F.substring(text, F.instr(text, start) + len(start), F.length(text)))
    return F.when(F.instr(rest, end) > 0, F.substring(rest, F.lit(1), F.instr(rest, end) - 1))


def embedded(page: Column) -> Column:
    """The page's data as a variant: a JSON string, closed by its first quote that isn't escaped, whose value is JSON again.

    Pairs that begin with a backslash are blotted out, lengths kept, to find that quote: a pattern that repeats a choice
    would overflow the stack on long pages.
    """
    rest = F.when(F.instr(page, CONTEXT) > 0, F.substring(page, F.instr(page, CONTEXT) + len(CONTEXT), F.length(page)))
    plain = F.replace(F.replace(rest, F.lit("\\\\"), F.lit("\x01\x01")), F.lit('\\"'), F.lit("\x01\x01"))
    raw = F.when(F.instr(plain, '"') > 0, F.substring(rest, F.lit(1), F.instr(plain, '"') - 1))
    return F.try_parse_json(F.from_json(F.concat(F.lit('{"v":"'), raw, F.lit('"}')), "v string")["v"])


def _shown(node: Column) -> Column:
    """struct(media_type, image, video) of a slide, or of a post itself."""
    is_video = F.coalesce(F.try_variant_get(node, "$.is_video", "boolean"), F.lit(False))
    part = lambda name: F.try_variant_get(node, f"$.{name}", "string")
    return F.struct(F.when(is_video, "VIDEO").otherwise("IMAGE").alias("media_type"), part("display_url").alias("image"), F.when(is_video, part("video_url")).alias("video"))


def posts(pages: DataFrame, page: str) -> DataFrame:
    """pages with author, id, media_type, caption, taken_at (seconds; null: unknown, so that now stands in), media (array of
    media_type, image, video), by_data (whether the embedded data gave them) and refused (why there is no post; else null).

    The data must name an author and an id of digits only; else the markup must show an author and a picture. Its id is null,
    as the link's code is all there is, and its caption is without the author it begins with. An author must be a valid
    account name. Null and empty pages show no post.
    """
    columns = pages.columns
    said = lambda path, kind="string": F.try_variant_get("_d", f"{MEDIA}{path}", kind)
    rows = pages.withColumn("_d", embedded(F.col(page)))
    of_type = F.try_element_at(F.create_map(*[F.lit(x) for pair in MEDIA_TYPES.items() for x in pair]), F.coalesce(said(".__typename"), F.lit("")))
    whole_number = F.schema_of_variant(said(".taken_at_timestamp", "variant")) == "BIGINT"
    slides = F.transform(F.coalesce(said(".edge_sidecar_to_children.edges", "array<variant>"), F.array().cast("array<variant>")), lambda e: _shown(F.try_variant_get(e, "$.node", "variant")))
    kind = F.coalesce(of_type, F.lit("IMAGE"))
    data = F.struct(
        said(".owner.username").alias("author"), said(".id").alias("id"), kind.alias("media_type"), F.coalesce(said(".edge_media_to_caption.edges[0].node.text"), F.lit("")).alias("caption"),
        F.when(whole_number, said(".taken_at_timestamp", "long")).alias("taken_at"), F.when(kind == "CAROUSEL_ALBUM", slides).otherwise(F.array(_shown(said("", "variant")))).alias("media"),
    )
    rows = rows.withColumn("_data", F.when((said(".owner.username") != "") & said(".id").rlike("^[0-9]+$"), data)).drop("_d")

    markup = F.when(F.col("_data").isNull(), F.col(page))
    found = lambda pattern: F.nullif(F.regexp_extract(markup, pattern, 1), F.lit(""))
    bare = F.regexp_replace(F.regexp_replace(between(markup, *CAPTION), r"<br\s*/?>", "\n"), "<[^>]+>", "")
    rows = rows.withColumn("_name", found(AUTHOR)).withColumn("_image", unescaped(found(IMAGE))).withColumn("_text", F.regexp_replace(unescaped(bare), r"^\s+|\s+$", ""))
    caption = F.when(F.startswith("_text", F.col("_name")), F.regexp_replace(F.substring("_text", F.length("_name") + 1, F.length("_text")), r"^\s+|\s+$", "")).otherwise(F.coalesce("_text", F.lit("")))
    none = F.lit(None).cast("string")
    shown = F.struct(
        F.col("_name").alias("author"), none.alias("id"), F.lit("IMAGE").alias("media_type"), caption.alias("caption"), F.lit(None).cast("long").alias("taken_at"),
        F.array(F.struct(F.lit("IMAGE").alias("media_type"), F.col("_image").alias("image"), none.alias("video"))).alias("media"),
    )
    rows = rows.withColumn("_post", F.coalesce("_data", F.when(F.col("_name").isNotNull() & F.col("_image").isNotNull(), shown)))
    p = F.col("_post")
    account = F.rtrim(F.lower(F.nullif(F.regexp_extract(F.btrim(p["author"]), ACCOUNT, 1), F.lit(""))), F.lit("."))
    refused = F.when(p.isNull(), NO_POST).when(account.isNull(), ODD_AUTHOR)
    kept = F.when(refused.isNull(), p.withField("author", account))
    return rows.select(*columns, *[kept[f].alias(f) for f in ("author", "id", "media_type", "caption", "taken_at", "media")], F.when(refused.isNull(), F.col("_data").isNotNull()).alias("by_data"), refused.alias("refused"))
