"""Exported posts as a data source: batch, stream, and a stream that goes on from its checkpoint."""

import json

import pytest

from heraldo.sources import posts, readers


def export(folder, name, *given):
    (folder / name).write_text("".join(json.dumps({"account": a, "id": i, "timestamp": f"2026-10-{day:02d}T10:00:00", "caption": f"ñ {i}"}) + "\n" for a, i, day in given))


@pytest.fixture
def folder(spark, tmp_path):
    spark.dataSource.register(posts.ExportedPosts)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    exported = tmp_path / "exports"
    exported.mkdir()
    return exported


def test_every_line_is_read_once_however_files_are_cut(spark, folder):
    export(folder, "a.jsonl", *[(f"acc{i % 3}", str(i), i % 28 + 1) for i in range(60)])
    (folder / "b.jsonl").write_text('\n{"account": "ana", "id": 7}')  # a blank line; no end of the last one
    export(folder, "_c.jsonl", ("no", "no", 1))
    for chunk in (120, 777, 1 << 20):
        found = spark.read.format("exported_posts").option("chunk", chunk).load(str(folder))
        assert sorted(r["id"] for r in found.collect()) == sorted([str(i) for i in range(60)] + ["7"]), chunk
    assert found.rdd.getNumPartitions() == 2
    one = found.where("account = 'ana'").collect()
    assert [(r["account"], r["id"], r["permalink"], r["file"]) for r in one] == [("ana", "7", None, "b.jsonl")]
    newest = readers.latest_posts(found.where("account like 'acc%'"), 2).collect()
    assert sorted((r["account"], r["id"]) for r in newest) == [("acc0", "27"), ("acc0", "54"), ("acc1", "25"), ("acc1", "55"), ("acc2", "26"), ("acc2", "53")]


def test_a_folder_without_files_and_a_broken_line(spark, folder):
    assert spark.read.format("exported_posts").load(str(folder)).collect() == []
    (folder / "a.jsonl").write_text('{"account": "ana", "id": "1"}\n{"account"\n')
    with pytest.raises(Exception, match="a.jsonl, byte 30"):
        spark.read.format("exported_posts").load(str(folder)).collect()


def test_a_stream_goes_on_where_it_stopped(spark, folder, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        stream = spark.readStream.format("exported_posts").option("files", 1).load(str(folder))
        query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).start(out)
        query.processAllAvailable()
        batches = query.lastProgress["batchId"]
        query.stop()
        return batches, sorted((r["account"], r["id"]) for r in spark.read.parquet(out).collect())

    export(folder, "2026-10-01.jsonl", ("ana", "1", 1), ("bea", "2", 1))
    export(folder, "2026-10-02.jsonl", ("ana", "3", 2))
    assert run()[1] == [("ana", "1"), ("ana", "3"), ("bea", "2")]
    export(folder, "2026-10-03.jsonl", ("ana", "4", 3))
    again, rows = run()
    assert rows == [("ana", "1"), ("ana", "3"), ("ana", "4"), ("bea", "2")] and again >= 2
