"""Readings stored batch by batch: ids kept, posts joined, events called off, and a batch killed between its two tables."""

import datetime as dt

import pytest

from heraldo.streaming import store

DAY = dt.date(2026, 10, 24)
BATCH = "post string, account string, at timestamp, is_event_post boolean, cancels boolean, provisional boolean, readings array<struct<date:date,title:string,start_time:string,event_type:string>>, refused array<string>"


def reading(post, account, *found, cancels=False, refused=(), hour=10):
    return (post, account, dt.datetime(2026, 10, 1, hour), bool(found or refused), cancels, True, [(DAY, title, start, "social") for title, start in found], list(refused))


def put(spark, path, number, *rows, every=3):
    store.take(spark.createDataFrame(rows, BATCH), number, path, every)
    return state(spark, path, number, every)


def state(spark, path, number, every=3):
    events = {r["id"]: r for r in store.table(spark, path, "events", "id", number, every).collect()}
    return events, {r["post"]: r for r in store.table(spark, path, "records", "post", number, every).collect()}


def test_events_and_records_change_together(spark, tmp_path):
    path = str(tmp_path)
    events, records = put(spark, path, 0, reading("p1", "ana", ("Salsa", "20:00"), ("Taller", "18:00")), reading("p2", "bea"), reading("p3", "bea", refused=["sin fecha", "recurrente"]), reading("p1", "ana", ("Old", None), hour=9))
    social, taller = records["p1"]["event_ids"]
    assert [events[i]["title"] for i in (social, taller)] == ["Salsa", "Taller"] and len(events) == 2
    assert {p: (r["outcome"], r["detail"]) for p, r in records.items()} == {"p1": ("event", None), "p2": ("not_event", None), "p3": ("discarded", "recurrente, sin fecha")}
    # read again in another order with one more, ids stay; another post of the account joins one; two posts of one batch join
    events, records = put(spark, path, 1, reading("p1", "ana", ("Zouk", "22:00"), ("taller", "18:00"), ("SALSA", "20:00")), reading("p5", "caro", ("Gala", None)), reading("p6", "caro", ("gala", None)))
    zouk = records["p1"]["event_ids"][0]
    assert records["p1"]["event_ids"][1:] == [taller, social] and zouk not in (social, taller)
    assert records["p5"]["outcome"] == "event" and records["p6"]["outcome"] == "merged" and records["p5"]["event_ids"] == records["p6"]["event_ids"]
    events, records = put(spark, path, 2, reading("p4", "ana", ("salsa", "20:00")))
    assert (records["p4"]["outcome"], records["p4"]["event_ids"], sorted(events[social]["posts"])) == ("merged", [social], ["p1", "p4"])
    # p1 says it's off: its own go, and the one that p4 shares too, as it's the account's
    events, records = put(spark, path, 3, reading("p1", "ana", cancels=True))
    assert {e["title"] for e in events.values()} == {"Gala"}
    assert [(records[p]["outcome"], records[p]["detail"], records[p]["event_ids"]) for p in ("p1", "p4")] == [("discarded", "cancelado", [])] * 2 and not records["p4"]["provisional"]
    assert store.last_batch(spark, path) == 3


def test_another_accounts_event_is_only_doubted(spark, tmp_path):
    path = str(tmp_path)
    event = ("e1", "ana", DAY, "Salsa", "20:00", "social", ["p1", "p9"], None, ["a doubt"], False)
    for name, row, schema in (("events", event, store.EVENTS), ("records", ("p1", "ana", "event", None, ["e1"], False, False), store.RECORDS)):
        spark.createDataFrame([row], schema).write.parquet(f"{path}/{name}/batch=0")
    doubt = f"@bea {store.CANCEL_FLAG}"
    events, records = put(spark, path, 1, reading("p9", "bea", cancels=True))
    assert (events["e1"]["confidence"], events["e1"]["doubts"], events["e1"]["posts"]) == ("low", ["a doubt", doubt], ["p1"]) and records["p1"]["event_ids"] == ["e1"]
    events, records = put(spark, path, 2, reading("p1", "ana", ("Salsa y más", "21:00")))  # read again, it keeps the flag
    assert (events["e1"]["title"], events["e1"]["confidence"], events["e1"]["doubts"]) == ("Salsa y más", "low", [doubt])


def test_a_batch_killed_between_its_tables_is_repeated(spark, tmp_path, monkeypatch):
    rows = [reading("p1", "ana", ("Salsa", "20:00")), reading("p2", "ana", ("Zouk", None))], [reading("p1", "ana", cancels=True), reading("p2", "ana", ("Zouk", "21:00"))]
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    for n, batch in enumerate(rows):
        want = put(spark, good, n, *batch)
    put(spark, bad, 0, *rows[0])
    real = store.changes
    monkeypatch.setattr(store, "changes", lambda *a: (real(*a)[0], None))  # fails once events are written
    with pytest.raises(AttributeError):
        put(spark, bad, 1, *rows[1])
    monkeypatch.undo()
    assert store.last_batch(spark, bad) == 0 and len(state(spark, bad, 0)[0]) == 2
    assert put(spark, bad, 1, *rows[1]) == want and store.last_batch(spark, bad) == 1


def test_a_stream_of_readings(spark, tmp_path):
    for n in range(3):
        spark.createDataFrame([reading(f"p{n}", "ana", ("Salsa", "20:00")), reading("p0", "ana", (f"Show {n}", None), hour=11)], BATCH).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    path = str(tmp_path / "store")
    stream = spark.readStream.schema(BATCH).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    store.store(stream, path, every=2).awaitTermination()
    events, records = state(spark, path, store.last_batch(spark, path), 2)
    assert set(records) == {"p0", "p1", "p2"} and sorted(len(e["posts"]) for e in events.values()) == [1, 2]
