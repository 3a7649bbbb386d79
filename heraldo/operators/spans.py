"""Moments and the spans of time they lie in, by an equi-join on buckets of time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def containing(moments: DataFrame, spans: DataFrame, moment: str, span: str, at: str, first: str, last: str, block: list[str], width: int, most: int = 100_000) -> DataFrame:
    """(moment, span, n): each moment's first span, by start and key, and how many hold it; null and 0 where none does.

    moments: block, `moment` (unique), `at`; spans: block, `span` (unique), `first`, `last`, both ends included; positions
    are longs such as microseconds. A span lies in a level of buckets no shorter than itself, so in two of them at most however
    long it is; a moment looks in its bucket of each level there is. A bucket of more than `most` moments is dealt over parts,
    which its spans all visit. Nulls and spans that end before they start hold nothing.
    """
    sound = spans.where(F.col(first) <= F.col(last)).select(*block, span, F.col(first).alias("_first"), F.col(last).alias("_last"))
    length = (F.col("_last") - F.col("_first") + 1) / F.lit(width)
    levelled = sound.withColumn("_level", F.greatest(F.lit(0), F.ceil(F.log2(length) / 2)).cast("int"))
    wide = lambda level: F.pow(F.lit(4), level).cast("long") * F.lit(width)
    slot = lambda x: F.expr(f"{x} div _width")
    down = lambda x: F.when((F.col(x) % F.col("_width")) < 0, slot(x) - 1).otherwise(slot(x))
    held = levelled.withColumn("_width", wide(F.col("_level"))).withColumn("_bucket", F.explode(F.sequence(down("_first"), down("_last"))))
    levels = sorted(r[0] for r in levelled.select("_level").distinct().collect())  # at most 32 numbers
    known = moments.select(*block, moment, F.col(at).alias("_at"))
    looks = known.withColumn("_level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumn("_width", wide(F.col("_level"))).withColumn("_bucket", down("_at"))
    where = [*block, "_level", "_bucket"]
    crowds = looks.groupBy(*where).agg(F.count("*").alias("_n")).where(F.col("_n") > most).select(*where, F.ceil(F.col("_n") / most).cast("int").alias("_parts"))
    parts = F.coalesce("_parts", F.lit(1))
    dealt = looks.join(crowds, where, "left").withColumn("_part", F.pmod(F.xxhash64(moment), parts).cast("int"))
    visiting = held.join(crowds, where, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    pairs = dealt.select(*where, "_part", moment, "_at").join(visiting.select(*where, "_part", span, "_first", "_last"), [*where, "_part"]).where("_at between _first and _last")
    found = pairs.groupBy(moment).agg(F.min_by(span, F.struct("_first", span)).alias(span), F.count("*").alias("n"))
    return moments.select(moment).join(found, moment, "left").select(moment, span, F.coalesce("n", F.lit(0).cast("long")).alias("n"))
