"""Streams: sessions by gap with a watermark, and posts taken in micro-batches into a keyed table."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heraldo.operators import state


def session_counts(stream: DataFrame, key: str, at: str, gap: str, late: str) -> DataFrame:
    """(key, first_at, last_at, n) of each key's sessions; rows later than `late` are dropped. `at` must be a timestamp."""
    window = F.session_window(at, gap)
    return stream.withWatermark(at, late).groupBy(key, window).agg(F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count("*").alias("n")).select(key, "first_at", "last_at", "n")


def run_once(result: DataFrame, path: str) -> DataFrame:
    """Runs a stream over what there is and gives its result as a table; the checkpoint lies beside the output."""
    query = result.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return result.sparkSession.read.schema(result.schema).parquet(f"{path}/out")


def upsert_batches(stream: DataFrame, path: str, keys: list[str], version: list[str]):
    """A query that keeps each key's newest row in path/table-<n>, written anew by each batch and named last in path/current.

    A batch that is repeated after a failure gives the same table, so that the state is right whatever was lost. The table
    before last is deleted once the next is named; the last one stays for readers that opened it.
    """

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = state.latest(batch, keys, version)
        if number:
            new = state.upsert(spark.read.schema(batch.schema).parquet(f"{path}/table-{number - 1}"), new, keys, version)
        new.write.mode("overwrite").parquet(f"{path}/table-{number}")
        spark.createDataFrame([(number,)], "number long").coalesce(1).write.mode("append").json(f"{path}/current")
        if number > 1:
            old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/table-{number - 2}")
            old.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(old, True)

    return stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()


def current(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table that upsert_batches named last; an empty one before the first batch."""
    try:
        last = spark.read.schema("number long").json(f"{path}/current").agg(F.max("number")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/table-{last}")


def first_seen(stream: DataFrame, keys: list[str], at: str, within: str) -> DataFrame:
    """A stream's rows without repeats of their keys; state of a key is let go once the watermark is `within` past its row."""
    return stream.withWatermark(at, within).dropDuplicatesWithinWatermark(keys)


def scratch(spark: SparkSession) -> str:
    """A new folder for a stream's output: in the cluster's shared folder, or in the warehouse where none is named."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base}/stream-{uuid.uuid4().hex}"
