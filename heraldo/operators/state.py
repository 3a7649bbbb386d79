"""Upkeep of keyed tables: change capture, upserts, tombstones, retention, archives, references and fingerprints."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def digest(text: Column, length: int = 64) -> Column:
    """The first hex digits of a text's SHA-256; null for null."""
    return F.substring(F.sha2(text, 256), 1, length)


def actions(current: DataFrame, stored: DataFrame, key: str, mark: str) -> DataFrame:
    """(key, action): new, changed, unchanged or missing, by the marks that both tables hold for a key."""
    both = current.select(key, F.col(mark).alias("now"), F.lit(True).alias("here")).join(stored.select(key, F.col(mark).alias("then"), F.lit(True).alias("there")), key, "full")
    action = F.when(F.col("there").isNull(), "new").when(F.col("here").isNull(), "missing").when(F.col("now").eqNullSafe(F.col("then")), "unchanged").otherwise("changed")
    return both.select(key, action.alias("action"))


def upsert(stored: DataFrame, new: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """Both tables' latest row per key; on equal versions the new table's."""
    both = stored.withColumn("fresh", F.lit(0)).unionByName(new.withColumn("fresh", F.lit(1)))
    return latest(both, keys, [*version, "fresh"]).drop("fresh")


def latest(rows: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """Each key's row with the greatest version: a grouped maximum, combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*version)).alias("row"))
    return best.select(*keys, *[F.col("row")[c].alias(c) for c in rest]).select(*rows.columns)


def write_archive(rows: DataFrame, stored: DataFrame | None, path: str, keys: list[str], version: list[str], day: str) -> None:
    """Adds rows to an archive by year, newest row per key; only the years that change are rewritten."""
    dated = rows.withColumn("year", F.coalesce(F.year(day), F.lit(0)))
    if stored is not None:
        touched = dated.select("year").distinct()
        dated = upsert(stored.join(touched, "year", "left_semi").select(*dated.columns), dated, ["year", *keys], version)
    dated.repartition("year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def without(rows: DataFrame, tombstones: DataFrame, condition: Column | list[str]) -> DataFrame:
    """The rows that no tombstone matches."""
    return rows.join(tombstones, condition, "left_anti")


def unreferenced(files: DataFrame, references: DataFrame, key: str) -> DataFrame:
    """The files that no reference names."""
    return files.join(references.select(key), key, "left_anti")


def retained(rows: DataFrame, day: str, cutoff: Column) -> DataFrame:
    """rows with `kept`: whether they stay or go to the archive. Rows without a day stay."""
    return rows.withColumn("kept", F.coalesce(F.col(day) >= cutoff, F.lit(True)))


def detached(groups: DataFrame, items: str, keep: Callable[[Column], Column]) -> DataFrame:
    """groups whose array lacks the items that `keep` refuses; groups left with none go."""
    return groups.withColumn(items, F.filter(items, keep)).where(F.size(items) > 0)


def first_known(value: Column, order: Column) -> Column:
    """The first value that is known, in that order: an aggregate."""
    return F.min_by(value, F.when(value.isNotNull(), order))


def newest_known(value: Column, order: Column) -> Column:
    return F.max_by(value, F.when(value.isNotNull(), order))


def fingerprint(rows: DataFrame, key: Column) -> DataFrame:
    """(fingerprint): one hash of a set of keys, whatever their order and repeats. For small sets such as warnings."""
    return rows.agg(F.sha2(F.array_join(F.array_sort(F.collect_set(key)), "\n"), 256).alias("fingerprint"))


def content_mark(rows: DataFrame) -> DataFrame:
    """(rows, mark): an order-free mark of any table's content, combined before the shuffle."""
    each = F.xxhash64(*rows.columns)
    return rows.agg(F.count("*").alias("rows"), F.bit_xor(each).alias("mark"))


def numbered_ids(rows: DataFrame, base: Column, order: list[str]) -> DataFrame:
    """rows with `id`: the base, and from the second row with that base on a number after it."""
    named = rows.withColumn("base", base)
    n = F.row_number().over(Window.partitionBy("base").orderBy(*order))
    return named.withColumn("n", n).withColumn("id", F.when(F.col("n") == 1, F.col("base")).otherwise(F.concat_ws("-", "base", F.col("n").cast("string")))).drop("n", "base")


def give_up(misses: Column, found: Column, most: int = 3) -> Column:
    """struct(misses, given_up): misses in a row after one more read, and whether to stop."""
    now = F.when(found, 0).otherwise(F.coalesce(misses, F.lit(0)) + 1)
    return F.struct(now.alias("misses"), (now >= most).alias("given_up"))
