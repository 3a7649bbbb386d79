"""Writers of what the pipeline publishes: ordered events, whole snapshots, bounded histories and text reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HISTORY_RUNS, DETAILED_RUNS = 180, 14


def in_order(events: DataFrame, date: str = "date", start: str = "start_time") -> DataFrame:
    """Events by day and start, those without a day last and those without a start first."""
    return events.orderBy(F.coalesce(F.col(date).cast("string"), F.lit("9999")), F.coalesce(start, F.lit("")))


def replace(rows: DataFrame, path: str, kind: str = "json") -> None:
    """Writes rows beside path, then puts them in its place: a reader finds the old table or the new one, never a part
    of one; a job that fails leaves the old one."""
    spark = rows.sparkSession
    mark = uuid.uuid4().hex
    fresh, old = f"{path}.{mark}.new", f"{path}.{mark}.old"
    rows.write.format(kind).save(fresh)
    place = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    files = place(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    had = files.exists(place(path))
    if had and not files.rename(place(path), place(old)):
        raise OSError(f"{path} can't be moved")
    if not files.rename(place(fresh), place(path)):
        if had:
            files.rename(place(old), place(path))
        raise OSError(f"{path} can't be replaced")
    if had:
        files.delete(place(old), True)


def bounded_history(runs: DataFrame, at: str, details: str, most: int = HISTORY_RUNS, detailed: int = DETAILED_RUNS) -> DataFrame:
    """The newest runs; of all but the newest few the details are left out. The limit comes first, so the window sees
    `most` rows at most."""
    newest = runs.orderBy(F.desc(at)).limit(most)
    place = F.row_number().over(Window.orderBy(F.desc(at)))
    return newest.withColumn("__place", place).withColumn(details, F.when(F.col("__place") <= detailed, F.col(details))).drop("__place")


def added(known: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The rows to append so that each key is there once."""
    return new.dropDuplicates([key]).join(known.select(key), key, "left_anti")


def report(lines: DataFrame, by: str) -> DataFrame:
    """(by, text): each report's (at, line) rows as one text, in order. For reports, which are short."""
    return lines.groupBy(by).agg(F.expr("listagg(line, '\\n') within group (order by at)").alias("text"))
