"""Counters of reads over micro-batches: days, misses in a row, restarts from the checkpoint, keys forgotten."""

import datetime as dt

from heraldo.streaming import counters

SCHEMA = "k string, at timestamp, found boolean"
D = dt.datetime(2026, 10, 5, 8)
H = dt.timedelta(hours=1)


def test_counters_go_on_from_the_checkpoint(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "run")
    batches = [
        [("a", D, True), ("a", D + H, False), ("b", D, False), ("b", D + H, False), ("c", D, None), (None, D, True), ("d", None, True)],
        [("a", D + 2 * H, False), ("a", D + 3 * H, False), ("b", D + 24 * H, False), ("c", D + H, True)],
        [("a", D + H, True), ("b", D + 25 * H, True), ("b", D + 26 * H, False), ("c", D + 2 * H, False)],
    ]
    expected = [
        {"a": (2, 1, False), "b": (2, 2, False), "c": (1, 1, False)},
        {"a": (4, 3, True), "b": (1, 3, True), "c": (2, 0, False)},
        {"a": (5, 3, True), "b": (3, 1, False), "c": (3, 1, False)},
    ]
    for rows, now in zip(batches, expected):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        for _ in range(2):  # a run without new reads changes nothing
            stream = counters.read_counters(spark.readStream.schema(SCHEMA).parquet(source), "k", "at", "found", late="2 days")
            counters.run(stream, out)
        assert {r.k: (r.used, r.misses, r.given_up) for r in counters.current(spark, out, stream.schema, "k").collect()} == now


def test_idle_keys_are_forgotten(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "run")
    later = D + dt.timedelta(days=20)
    for rows in ([("a", D, False), ("a", D + H, False)], [("z", later, True)], [("z", later + H, True)], [("a", later, False)]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = counters.read_counters(spark.readStream.schema(SCHEMA).parquet(source), "k", "at", "found", idle_days=10)
        counters.run(stream, out)
    assert {r.k: (r.used, r.misses) for r in counters.current(spark, out, stream.schema, "k").collect()} == {"a": (1, 1), "z": (2, 0)}
