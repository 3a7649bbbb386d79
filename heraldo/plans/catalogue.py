"""The registered queries of the library's own operators, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heraldo.functions import dates
from heraldo.plans import announced, answered, entities, merged, reports, resolved, scheduling, series


def occurrence_weekend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as spans of one to seven days; the first day of each on the weekend of 17 to 19 January 1997."""
    first = F.to_date("o_orderdate")
    spans = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", dates.days_of(first, F.date_add(first, (F.col("o_orderkey") % 7).cast("int"))).alias("days"))
    weekend = dates.weekend(F.lit("1997-01-15").cast("date"))
    return spans.select("o_orderkey", dates.occurrence(F.col("days"), weekend["first"], weekend["last"]).alias("day")).where("day is not null")


QUERIES = {"occurrence_weekend": occurrence_weekend} | entities.QUERIES | reports.QUERIES | series.QUERIES | scheduling.QUERIES | announced.QUERIES | resolved.QUERIES | merged.QUERIES | answered.QUERIES

ORACLE_SQL = {
    "occurrence_weekend": """
SELECT o_orderkey, min(day) AS day FROM (
  SELECT o_orderkey, CAST(unnest(generate_series(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + CAST(o_orderkey % 7 AS INTEGER), INTERVAL 1 DAY)) AS DATE) AS day FROM orders)
WHERE day BETWEEN DATE '1997-01-17' AND DATE '1997-01-19' GROUP BY 1
"""
} | entities.ORACLE_SQL | reports.ORACLE_SQL | series.ORACLE_SQL | scheduling.ORACLE_SQL | announced.ORACLE_SQL | resolved.ORACLE_SQL | merged.ORACLE_SQL | answered.ORACLE_SQL
