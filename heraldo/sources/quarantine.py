"""Records read from text one by one, so that what can't be read loses itself and not the run: it is set apart with its reasons."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

READ, REFUSED = "read", "refused"


def sorted_records(raw: DataFrame, text: str, schema: StructType, required: list[str], rules: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """raw with `record`, what its JSON text holds by the schema, and `reasons`, why it isn't taken (empty: it is).

    Reasons, in order: empty; not JSON; or wrong type, missing and unknown fields by name, and each rule of the record that
    holds. A field of null counts as missing. Nothing is dropped; the text stays, so that refused rows can be read again.
    """
    corrupt = "_unread"
    assert corrupt not in schema.names
    parsed = F.from_json(text, f"{schema.toDDL()}, {corrupt} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    rows = raw.withColumn("_p", parsed)
    names = F.array(*map(F.lit, schema.names))
    record = F.struct(*[F.col("_p")[f].alias(f) for f in schema.names])
    blank = F.coalesce(F.btrim(text) == "", F.lit(True))
    is_object = F.json_object_keys(text).isNotNull() & F.try_parse_json(text).isNotNull()
    said = lambda f: F.get_json_object(text, f"$['{f}']").isNotNull()
    unknown = F.transform(F.array_sort(F.array_except(F.json_object_keys(text), names)), lambda k: F.concat(F.lit("unknown "), k))
    held = [F.when(F.coalesce(holds(F.col("record")), F.lit(False)), why) for why, holds in (rules or {}).items()]
    amiss = F.concat(
        F.array_compact(F.array(F.when(F.col("_p")[corrupt].isNotNull(), "wrong type"), *[F.when(~said(f), f"missing {f}") for f in required])), unknown,
        F.array_compact(F.array(*held)) if held else F.array().cast("array<string>"),
    )
    reasons = F.when(blank, F.array(F.lit("empty"))).when(~is_object, F.array(F.lit("not JSON"))).otherwise(amiss)
    return rows.withColumn("record", record).withColumn("reasons", reasons).drop("_p")


def write_sorted(rows: DataFrame, path: str, run: str) -> None:
    """Writes a run's sorted records in one job, those read and those refused in folders of their own. A repeated run replaces its own."""
    outcome = F.when(F.size("reasons") == 0, READ).otherwise(REFUSED)
    rows.withColumn("outcome", outcome).write.mode("overwrite").partitionBy("outcome").parquet(f"{path}/run={run}")


def stored(spark: SparkSession, path: str, outcome: str) -> DataFrame:
    """The records of all runs that were read, or those refused, with their run; the other folders are not read."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/run=*").where(F.col("outcome") == outcome)
    return rows.drop("outcome")
