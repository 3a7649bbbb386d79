"""Micro-batches into a keyed table, and repeats left out of a stream."""

import datetime as dt

from heraldo.streaming import sessions

SCHEMA = "k long, v long, word string"


def test_batches_keep_each_keys_newest_row(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    assert sessions.current(spark, out, SCHEMA).collect() == []
    batches = [[(1, 1, "a"), (2, 1, "b")], [(1, 3, "c"), (3, 1, "d")], [(1, 2, "late"), (2, 2, "e"), (2, 2, "e")]]
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        query = sessions.upsert_batches(spark.readStream.schema(SCHEMA).parquet(source), out, ["k"], ["v"])
        query.awaitTermination()
    assert sorted(tuple(r) for r in sessions.current(spark, out, SCHEMA).collect()) == [(1, 3, "c"), (2, 2, "e"), (3, 1, "d")]
    assert sorted(p.name for p in (tmp_path / "out").glob("table-*")) == ["table-1", "table-2"]


def test_repeats_are_left_out(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [(k, dt.datetime(2026, 1, 1, h)) for k, h in ((1, 0), (1, 1), (2, 1), (1, 2))]
    spark.createDataFrame(rows, "k long, at timestamp").coalesce(1).write.parquet(source)
    stream = spark.readStream.schema("k long, at timestamp").parquet(source)
    found = sessions.run_once(sessions.first_seen(stream, ["k"], "at", "1 day"), str(tmp_path / "run"))
    assert sorted(r.k for r in found.collect()) == [1, 2]
