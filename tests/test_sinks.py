"""The writers, on small tables."""

import os

import pytest
from pyspark.sql import functions as F

from heraldo.sources import sinks


def test_events_in_order(spark):
    rows = spark.createDataFrame([(1, None, None), (2, "2026-01-02", "20:00"), (3, "2026-01-02", None), (4, "2026-01-01", "23:00")], "id int, date string, start_time string")
    assert [r["id"] for r in sinks.in_order(rows).collect()] == [4, 3, 2, 1]


def test_a_snapshot_is_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    for n in (3, 2):
        sinks.replace(spark.range(n), path)
        assert spark.read.schema("id long").json(path).count() == n
    with pytest.raises(Exception, match="stop"):
        sinks.replace(spark.range(5).select(F.raise_error(F.lit("stop")).alias("id")), path)
    assert spark.read.schema("id long").json(path).count() == 2
    assert [x for x in os.listdir(tmp_path) if x.endswith(".old")] == []


def test_histories_are_bounded(spark):
    runs = spark.createDataFrame([(i, f"d{i}") for i in range(6)], "at int, changes string")
    got = sorted(map(tuple, sinks.bounded_history(runs, "at", "changes", most=4, detailed=2).collect()))
    assert got == [(2, None), (3, None), (4, "d4"), (5, "d5")]


def test_keys_are_added_once(spark):
    known, new = spark.createDataFrame([("a",)], "account string"), spark.createDataFrame([("a",), ("b",), ("b",)], "account string")
    assert [tuple(r) for r in sinks.added(known, new, "account").collect()] == [("b",)]


def test_reports_are_in_order(spark):
    lines = spark.createDataFrame([("r", 2, "two"), ("r", 1, "one"), ("s", 1, "x")], "name string, at int, line string")
    assert sorted(map(tuple, sinks.report(lines, "name").collect())) == [("r", "one\ntwo"), ("s", "x")]
