"""Counters of reads kept for each key over a stream: requests of the day, misses in a row, when to give up.

Needs the RocksDB state store, which `run` names for the time it starts a query.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StructType, TimestampType

from heraldo.operators import state

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY = 86_400_000_000


class _Reads(StatefulProcessor):
    """One key's counters as (last, used, misses): the latest read's moment in microseconds, reads of its day, misses in a row.

    Only moments and outcomes of one key's reads within a micro-batch are held at once.
    """

    def __init__(self, key: str, most: int, idle_days: int) -> None:
        self.key, self.most, self.idle = key, most, idle_days * DAY // 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counters = handle.getValueState("counters", StructType().add("last", LongType()).add("used", LongType()).add("misses", LongType()))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        parts = [part[["read_micros", "was_found"]] for part in rows if len(part)]
        if not parts:
            return
        reads = pd.concat(parts)
        last, used, misses = self.counters.get() if self.counters.exists() else (None, 0, 0)
        newest = int(reads["read_micros"].max()) if last is None else max(last, int(reads["read_micros"].max()))
        today = (reads["read_micros"] // DAY == newest // DAY).sum()
        used = int(today) + (used if last is not None and last // DAY == newest // DAY else 0)
        fresh = reads if last is None else reads[reads["read_micros"] > last]
        found = fresh.loc[fresh["was_found"], "read_micros"].max()
        missed = fresh.loc[~fresh["was_found"], "read_micros"]
        misses = misses + len(missed) if pd.isna(found) else int((missed > found).sum())
        self.counters.update((newest, used, int(misses)))
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(newest // 1000 + self.idle)
        yield pd.DataFrame({self.key: [key[0]], "at": [pd.Timestamp(newest, unit="us")], "used": [used], "misses": [int(misses)], "given_up": [misses >= self.most]})

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.counters.clear()
        return iter(())

    def close(self) -> None:
        pass


def read_counters(stream: DataFrame, key: str, at: str, found: str, most: int = 3, late: str = "1 day", idle_days: int = 90) -> DataFrame:
    """(key, at, used, misses, given_up), a row for each key that a micro-batch reads: its counters after it.

    used: reads on the day (UTC) of the key's latest read. misses: reads in a row that didn't find it, up to the latest; a find
    sets it back. given_up: `most` misses or more. Of reads older than the key's latest in earlier batches only `used` takes
    note; reads `late` behind the watermark are dropped, so are those without a key or moment; a null outcome is a miss. A
    key is forgotten once the watermark is idle_days past its latest read.
    """
    reads = stream.withWatermark(at, late).where(F.col(key).isNotNull() & F.col(at).isNotNull())
    reads = reads.select(key, at, F.unix_micros(at).alias("read_micros"), F.coalesce(F.col(found), F.lit(False)).alias("was_found"))
    out = StructType().add(key, stream.schema[key].dataType).add("at", TimestampType()).add("used", LongType()).add("misses", LongType()).add("given_up", BooleanType())
    return reads.groupBy(key).transformWithStateInPandas(statefulProcessor=_Reads(key, most, idle_days), outputStructType=out, outputMode="Append", timeMode="EventTime")


def run(counters: DataFrame, path: str) -> None:
    """Takes what a stream holds; path keeps the counters' rows and the checkpoint, from which a later run goes on."""
    conf = counters.sparkSession.conf
    before = conf.get(PROVIDER)
    conf.set(PROVIDER, ROCKSDB)
    try:
        counters.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        conf.set(PROVIDER, before)


def current(spark: SparkSession, path: str, schema: StructType, key: str) -> DataFrame:
    """Each key's counters as of its latest row."""
    return state.latest(spark.read.schema(schema).parquet(f"{path}/out"), [key], ["at", "used", "misses"])
