"""Why a post is shown or not: each rung of the ladder on a table of its own posts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from heraldo.operators import diagnosis

NOW = dt.datetime(2026, 10, 20, 17, 0)
AGO = lambda days, hours=0: NOW - dt.timedelta(days=days, hours=hours)
LINK = "https://red.example/p/{}/"

# code: (outcome, reason, detail, event_ids, is_event_post, provisional)
RECORDS = {
    "shown": ("event", "two dances", None, ["e1", "e2"], True, False), "joined": ("merged", "again", None, ["e1"], True, True), "over": ("event", "", None, ["old"], True, False),
    "gone": ("event", "", None, ["nowhere"], True, False), "dropped": ("discarded", "", "sin fecha, recurrente", None, True, False), "vague": ("discarded", "", None, None, True, False),
    "veiled": ("hidden", "", None, None, True, False), "garbled": ("rejected", "no answer", None, None, False, False), "removed": ("not_event", "Quitado a mano: double", None, None, False, False),
    "advert": ("not_event", "sells shoes", None, [], False, False), "ancient": (None, "", None, None, True, False), "plain": (None, "a poem", None, None, False, False),
}
# code: (account, published)
FEED = {
    "fresh": ("ana", AGO(0, 1)), "early": ("bea", AGO(40)), "stale": ("ana", AGO(9)), "held": ("ana", AGO(2)), "lost": ("caro", AGO(3)), "first": ("dana", AGO(3)), "odd": ("bea", AGO(3)),
}


@pytest.fixture(scope="module")
def tables(spark):
    make = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    records = [("ana", LINK.format(c), o, d, r, "m", p, AGO(5), ids, e) for c, (o, r, d, ids, e, p) in RECORDS.items()]
    records.append(("zoe", LINK.format("advert"), "event", None, "later", "m", False, AGO(1), ["e1"], True))
    day = dt.date(2026, 11, 1)
    return {
        "records": make(records, "account string, permalink string, outcome string, detail string, reason string, model string, provisional boolean, processed_at timestamp, event_ids array<string>, is_event_post boolean"),
        "events": make([("e1", "Salsa", day, ["x"]), ("e2", "Zouk", dt.date(2026, 10, 20), []), ("old", "Past", dt.date(2026, 10, 19), []), ("e9", "Found", day, [LINK.format("ancient")])], "id string, title string, last_day date, permalinks array<string>"),
        "followed": make([(a,) for a in ("ana", "bea", "caro", "dana", "shut", "down", "eva")], "account string"),
        "feeds": make([("ana", None), ("bea", None), ("caro", None), ("dana", None), ("shut", "private"), ("down", "busy")], "account string, problem string"),
        "feed": make([(a, LINK.format(c), at) for c, (a, at) in FEED.items()], "account string, permalink string, published timestamp"),
        "states": make([("ana", dt.date(2026, 1, 1), AGO(1)), ("bea", dt.date(2026, 10, 1), None), ("caro", dt.date(2026, 1, 1), AGO(1))], "account string, first_seen date, last_read timestamp"),
        "runs": make([(AGO(2), False), (AGO(1), True)], "finished_at timestamp, pending boolean"),
        "tries": make([("caro", AGO(2), False), ("caro", AGO(1), True), ("ana", AGO(2), True), ("ana", AGO(1), False)], "account string, finished_at timestamp, failed boolean"),
    }


def explain(spark, tables, *asked, **changed):
    rows = spark.createDataFrame(asked, "link string, account string, author string")
    found = diagnosis.diagnose(rows, *[changed.get(t, tables[t]) for t in ("records", "events", "followed", "feeds", "feed", "states", "runs", "tries")], F.lit(NOW).cast("timestamp"), F.lit(NOW.date()))
    return {r["link"]: r for r in found.collect()}


def test_what_became_of_a_recorded_post(spark, tables):
    found = explain(spark, tables, *[(LINK.format(c), None, None) for c in RECORDS])
    verdict = {c: found[LINK.format(c)]["verdict"] for c in RECORDS}
    assert verdict == {
        "shown": "shown", "joined": "shown", "over": "over", "gone": "gone", "dropped": "discarded", "vague": "discarded", "veiled": "hidden", "garbled": "rejected", "removed": "removed", "advert": "not_event",
        "ancient": "shown", "plain": "not_event",
    }
    of = lambda c: found[LINK.format(c)]
    assert [c for c in RECORDS if not of(c)["add"]] == ["shown", "joined", "over", "removed", "ancient"]
    assert {c: of(c)["details"] for c in RECORDS if of(c)["details"]} == {
        "dropped": ["sin fecha", "recurrente"], "vague": ["no era publicable"], "garbled": ["no answer"], "removed": ["double"], "advert": ["sells shoes"], "plain": ["a poem"]
    }
    assert [e["id"] for e in of("shown")["shown"]] == ["e2", "e1"] and [e["title"] for e in of("ancient")["shown"]] == ["Found"] and of("over")["shown"] == []
    assert [tuple(c) for c in of("joined")["checks"]] == [("ok", "followed"), ("ok", "analyzed_for_now"), ("ok", "joined_events")]
    assert [tuple(c) for c in of("garbled")["checks"]] == [("ok", "followed"), ("ok", "analyzed"), ("no", "rejected")]


def test_why_an_unrecorded_post_was_not_read(spark, tables):
    asked = [(LINK.format(c), a, None) for c, (a, _) in FEED.items()]
    asked += [("https://red.example/ana/", "ana", None), (LINK.format("q1"), None, None), (LINK.format("q2"), "gil", None), (LINK.format("q3"), "eva", None), (LINK.format("q4"), "shut", None), (LINK.format("q5"), "down", None), ("https://red.example/Ana/p/q6/", None, None)]
    found = explain(spark, tables, *asked)
    assert {k: r["verdict"] for k, r in found.items()} == {
        LINK.format("fresh"): "after_last_read", LINK.format("early"): "before_first_read", LINK.format("stale"): "too_old", LINK.format("held"): "waiting", LINK.format("lost"): "last_read_failed",
        LINK.format("first"): "new_account", LINK.format("odd"): "waiting", "https://red.example/ana/": "not_a_post", LINK.format("q1"): "unknown_account", LINK.format("q2"): "not_followed",
        LINK.format("q3"): "not_looked_up", LINK.format("q4"): "private", LINK.format("q5"): "unreadable", "https://red.example/Ana/p/q6/": "not_in_feed",
    }
    assert {k for k, r in found.items() if not r["add"]} == {"https://red.example/ana/", LINK.format("q1"), LINK.format("q4"), LINK.format("q5"), "https://red.example/Ana/p/q6/"}
    assert [tuple(c) for c in found[LINK.format("held")]["checks"]] == [("ok", "followed"), ("info", "not_analyzed"), ("ok", "published")]
    assert found[LINK.format("q5")]["details"] == ["busy"]


def test_a_collaboration_is_judged_by_its_author(spark, tables):
    found = explain(spark, tables, (LINK.format("lost"), "ana", "caro"))[LINK.format("lost")]
    assert found["of_account"] == "caro" and found["verdict"] == "last_read_failed" and tuple(found["checks"][0]) == ("info", "collaboration")


def test_without_anything_on_record(spark, tables):
    none = {t: tables[t].where("false") for t in ("records", "events", "states", "runs", "tries")}
    known = spark.createDataFrame([("ana", dt.date(2026, 1, 1), None)], "account string, first_seen date, last_read timestamp")
    assert explain(spark, tables, (LINK.format("held"), "ana", None), **none)[LINK.format("held")]["verdict"] == "new_account"
    assert explain(spark, tables, (LINK.format("held"), "ana", None), **(none | {"states": known}))[LINK.format("held")]["verdict"] == "unexplained"
    assert explain(spark, tables, **none) == {}
