"""The readers of stores that aren't Parquet, on small files."""

import json

import pytest
from pyspark.sql import functions as F

from heraldo.sources import readers


def test_missing_documents_are_an_empty_table(spark, tmp_path):
    none = readers.json_documents(spark, str(tmp_path / "none.json"), "id string, n int")
    assert none.columns == ["id", "n"] and none.collect() == []
    (tmp_path / "some.json").write_text('[{"id": "a", "n": 1},\n {"id": "b"}]')
    assert sorted(map(tuple, readers.json_documents(spark, str(tmp_path / "some.json"), "id string, n int").collect())) == [("a", 1), ("b", None)]


def test_keyed_state(spark, tmp_path):
    (tmp_path / "state.json").write_text(json.dumps({"x": {"seen": "2026-01-01", "n": 2}, "y": {"n": 3}}))
    assert sorted(map(tuple, readers.keyed_state(spark, str(tmp_path / "state.json"), "struct<seen:string,n:int>").collect())) == [("x", "2026-01-01", 2), ("y", None, 3)]


def test_account_lists(spark, tmp_path):
    (tmp_path / "a.txt").write_text("﻿# all\n@uno\n\ndos bar # a bar\ntres solo:salsa,tango bar\nuno bar\n", encoding="utf-8")
    assert sorted(map(tuple, readers.accounts(spark, str(tmp_path / "a.txt")).collect())) == [("dos", True, []), ("tres", True, ["salsa", "tango"]), ("uno", True, [])]


@pytest.mark.parametrize("line", ["uno barr", "uno solo:", "uno solo:polka"])
def test_unknown_words_fail(spark, tmp_path, line):
    (tmp_path / "a.txt").write_text(line)
    with pytest.raises(Exception, match="unknown word"):
        readers.accounts(spark, str(tmp_path / "a.txt")).collect()


def test_latest_posts(spark):
    posts = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 3, "z"), ("b", 1, "w")], "account string, timestamp long, id string")
    assert sorted(r["id"] for r in readers.latest_posts(posts, 2).collect()) == ["w", "y", "z"]


def test_follow_lists(spark, tmp_path):
    page = '<a href="https://www.instagram.com/uno">x</a> <a href="https://www.instagram.com/_u/dos/">y</a> <a href="https://www.instagram.com/uno">z</a>'
    (tmp_path / "f.html").write_text(page)
    entries = [{"title": "uno"}, {"title": "", "string_list_data": [{"value": "dos"}]}, {"string_list_data": []}, {"title": "uno"}]
    (tmp_path / "f.json").write_text(json.dumps({"relationships_following": entries}))
    (tmp_path / "g.json").write_text(json.dumps(entries))
    for name in ("f.html", "f.json", "g.json"):
        rows = readers.following(spark, str(tmp_path / name)).orderBy("position").collect()
        assert [r["account"] for r in rows] == ["uno", "dos"], name


def test_screenshots(spark, tmp_path):
    for name, note in (("a", '{"name": "n.png", "modified": 5, "uploaded": "soon"}'), ("b", None), ("c", '{"name": 7}')):
        (tmp_path / f"{name}.jpg").write_bytes(name.encode())
        if note:
            (tmp_path / f"{name}.json").write_text(note)
    rows = readers.screenshots(spark, str(tmp_path)).orderBy("id").collect()
    assert [(r["id"], bytes(r["content"]), r["name"], r["modified"], r["uploaded"]) for r in rows] == [("a", b"a", "n.png", 5, None), ("b", b"b", "", None, None), ("c", b"c", "", None, None)]


def test_listings_say_if_more_follow(spark):
    assert [tuple(readers.listed(spark.range(n), 3).first()) for n in (0, 3, 4)] == [(0, False), (3, False), (3, True)]


def test_slides(spark):
    item = "struct<media_type:string,media_url:string,thumbnail_url:string>"
    rows = [(1, "IMAGE", "u", None, None), (2, "VIDEO", "v", "t", []), (3, "CAROUSEL_ALBUM", None, None, [("IMAGE", "a", None), ("VIDEO", "b", None), ("VIDEO", "c", "d")])]
    posts = spark.createDataFrame(rows, f"id int, t string, m string, h string, c array<{item}>")
    got = posts.orderBy("id").select(readers.slides(F.col("t"), F.col("m"), F.col("h"), F.col("c")).alias("s")).collect()
    assert [[tuple(x) for x in r["s"]] for r in got] == [[("IMAGE", "u", None)], [("VIDEO", "t", "v")], [("IMAGE", "a", None), ("VIDEO", "d", "c")]]


def test_usage_headers(spark):
    rows = [('{"call_count": 28, "total_time": 25}', '{"1": [{"call_count": 1, "total_cputime": 4}, {"call_count": 3}]}'), ("no json", None), (None, "[]")]
    got = spark.createDataFrame(rows, "a string, b string").select(readers.usage(F.col("a"), F.col("b")).alias("u")).collect()
    assert [r["u"] for r in got] == [{"X-App-Usage": {"call_count": 28, "total_time": 25}, "X-Business-Use-Case-Usage": {"call_count": 3, "total_cputime": 4}}, {}, {}]


def test_free_models(spark):
    rows = [("b:free", None, (["image"], ["text"]), ["structured_outputs"], 8), ("a", ("0", "0"), (["text", "image"], None), None, 4), ("c:free", None, (["image"], ["audio"]), None, 1), ("d", ("1", "0"), (["image"], None), None, 1), ("e:free", None, (["text"], None), None, 1)]
    got = readers.free_vision_models(spark.createDataFrame(rows, readers.MODEL)).collect()
    assert [tuple(r) for r in got] == [("b:free", True, False, 8), ("a", False, False, 4)]
