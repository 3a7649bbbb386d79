"""Shared ground of the training-data operators: tables, durable intermediate results, Arrow plumbing."""

from __future__ import annotations

import atexit
import gc
import tempfile
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Arrow batches are worked on in slices of about this many bytes of text, so that a task's memory does not follow the batch size.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of our own where the session names none (local tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='heraldo-')}")
    return spark.sparkContext.getCheckpointDir()


def _delete(spark: SparkSession, path: str) -> None:
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
    except Exception:  # the session may be gone at exit
        pass


def scratch(spark: SparkSession, label: str) -> str:
    """A path of its own in the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    return path


def persisted(df: DataFrame, label: str) -> DataFrame:
    """df as a table written to the shared folder: lineage ends there, so a lost executor costs a re-read only."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(df: DataFrame) -> None:
    """Deletes a persisted table that nothing reads any more."""
    for folder in {path.rpartition("/")[0] for path in df.inputFiles()}:
        _delete(df.sparkSession, folder)


def reclaimed(spark: SparkSession) -> None:
    """Frees the disk of shuffles that no DataFrame refers to any more, which Spark does when the driver collects its garbage.

    What refers to them goes in a first round only, so there are two.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices with about `limit` bytes of text each; one longer text is a slice of its own."""
    n = batch.num_rows
    if not n:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    begin = used = 0
    for i in range(n):
        if i > begin and used + sizes[i] > limit:
            yield batch.slice(begin, i - begin)
            begin, used = i, 0
        used += int(sizes[i])
    yield batch.slice(begin)


def ascii_lower(col):
    """A-Z only, unlike lower()."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Total bytes of a text column, to size batches and partitions by."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0
