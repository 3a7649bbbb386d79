import datetime as dt

import pytest

from heraldo.operators import announcements

EVENT = "id string, account string, title string, event_type string, venue string, organizer string, contact string, date date, end_date date, start_time string, sessions array<struct<date:date,start_time:string,end_time:string>>"
STORED, CANDIDATE = f"{EVENT}, pos int, posts array<string>", f"{EVENT}, post_id string, same_as string, announced array<string>"
DAY = dt.date(2026, 10, 10)


def event(id, title="Social", account="uno", event_type="social", venue=None, start=None, end_date=None, date=DAY, sessions=None):
    return (id, account, title, event_type, venue, None, None, date, end_date, start, sessions)


def match(spark, stored, candidate, same_as=None, announced=(), post="p2"):
    a = spark.createDataFrame([(*e, i, ["p1"]) for i, e in enumerate(stored)], STORED)
    b = spark.createDataFrame([(*candidate, post, same_as, list(announced))], CANDIDATE)
    found = announcements.find_existing(a, b).collect()
    return (found[0]["rule"], found[0]["a_id"]) if found else None


@pytest.mark.parametrize(
    ("stored", "candidate", "more", "expected"),
    [
        (event("s", start="20:00"), event("c", "Otra cosa", start="20:00"), {}, (2, "s")),
        (event("s", start="20:00"), event("c", start="21:00"), {}, None),
        (event("s", "Rincón Latino - Yemayá"), event("c", "Yemayá"), {}, (2, "s")),
        (event("s", "Taller con Ramiro"), event("c", "Social con Ramiro"), {}, None),
        (event("s", "Timba Congress", event_type="congress", end_date=DAY + dt.timedelta(2)), event("c", "Timba", event_type="party"), {"same_as": "s"}, None),
        (event("s"), event("c", "Lucero"), {"same_as": "s"}, (1, "s")),
        (event("s", start="18:00"), event("c", "Lucero", start="23:00"), {"announced": ["s"]}, (3, "s")),
        (event("s", "Tour Sabrosura", account="dos", venue="Patio Sur", start="20:00"), event("c", "Gran Tour", venue="Patio Sur Social", start="20:00"), {}, (4, "s")),
        (event("s", "Halloween Party", account="dos"), event("c", "Halloween Party"), {}, None),
        (event("s"), event("c", date=DAY + dt.timedelta(1)), {"same_as": "s"}, None),
        (event("s"), event("c"), {"post": "p1"}, None),
        (event("s", "Intensivo Timba", end_date=DAY + dt.timedelta(14), sessions=[(DAY, "14:00", None), (DAY + dt.timedelta(7), "14:00", None)]), event("c", "Timba sesión 2", date=DAY + dt.timedelta(7)), {}, (2, "s")),
    ],
)
def test_the_stored_event_that_a_candidate_is(spark, stored, candidate, more, expected):
    assert match(spark, [stored], candidate, **more) == expected


def test_normalized(spark):
    kind = "id int, title string, date string, end_date string, start_time string, end_time string, styles array<string>, contact string, in_bogota string, doubts array<string>"
    rows = [(1, "  Gran   noche", "2026-10-10", "2026-10-12", "9:05", "late", ["Salsa", "Salsa on2"], "@uno", "yes", None), (2, "b", "2026-02-30", None, "soon", None, None, None, "unknown", ["x"]), (3, "c", "2026-10-10", "2026-10-01", None, None, [], "", "yes", [])]
    found = {r["id"]: r for r in announcements.normalized(spark.createDataFrame(rows, kind), {"salsa": "salsa", "salsa on2": "salsa en línea"}).collect()}
    assert (found[1]["title"], found[1]["end_date"], found[1]["start_time"], found[1]["end_time"], found[1]["styles"]) == ("Gran noche", dt.date(2026, 10, 12), "09:05", None, ["salsa en línea"])
    assert found[2]["date"] is None and found[2]["doubts"] == ["x", "Hora de inicio no reconocida: soon", announcements.CITY_DOUBT]
    assert found[3]["end_date"] is None and found[3]["doubts"] == ["fecha final anterior a la inicial"]


def test_merged_fields(spark):
    rows = [("e", 1, "Flyer", None, "20:00"), ("e", 2, "Reminder", "Bar", "21:00"), ("e", 3, None, "Club", None)]
    posts = spark.createDataFrame(rows, "id string, published int, title string, venue string, start_time string")
    assert [tuple(r) for r in announcements.merged(posts, "id", "published", ["title", "venue", "start_time"]).collect()] == [("e", "Flyer", "Bar", "21:00")]


def test_merged_days_go_together(spark):
    rows = [("e", 1, "2026-10-01", "2026-10-03", "viernes"), ("e", 2, "2026-10-10", None, "sábado"), ("e", 3, None, "2026-10-30", None)]
    posts = spark.createDataFrame(rows, "id string, published int, date string, end_date string, weekday string")
    assert [tuple(r) for r in announcements.merged(posts, "id", "published", ["date", "end_date", "weekday"]).collect()] == [("e", "2026-10-10", None, "sábado")]


def test_hidden_events_and_reasons(spark):
    from pyspark.sql import functions as F

    hidden = spark.createDataFrame([(*event("h", "Gala Ocaso", start="20:00"), 0, ["p1"])], STORED)
    rows = [event("same", "Gala Ocaso", start="20:00"), event("other", "Gala Ocaso", date=DAY + dt.timedelta(3)), event("third", "Otra", account="tres")]
    candidates = spark.createDataFrame([(*r, "p2", None, []) for r in rows], CANDIDATE)
    assert {r["id"] for r in announcements.not_hidden(candidates, hidden).collect()} == {"other", "third"}
    why = spark.createDataFrame([(True, None, "no"), (False, DAY, "yes")], "r boolean, d date, b string").select(announcements.unpublishable(F.col("r"), F.col("d"), F.col("b")).alias("w")).collect()
    assert [r["w"] for r in why] == [["recurrente", "sin fecha", "fuera de Bogotá"], []]
