"""Sessions, merging in order, filters and labels."""

import datetime as dt

from pyspark.sql import functions as F

from heraldo.functions import labels
from heraldo.operators import filters, merging, sessions

D = lambda n: dt.date(2026, 11, 1) + dt.timedelta(n)
SESSION = "array<struct<date:date,start_time:string,end_time:string>>"


def of(spark, schema, rows, **columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*[c.alias(n) for n, c in columns.items()]).collect()]


def test_sessions_are_parsed(spark):
    raw = "s array<struct<date:string,start_time:string,end_time:string>>"
    rows = [([("2026-11-08", None, "17:00"), ("2026-11-01", "2:30", None), ("2026-11-08", "9:00", None), ("soon", "x", None), ("2026-11-15", "late", None)],), ([("2026-11-01", None, None)],), (None,)]
    got = of(spark, raw, rows, s=sessions.parsed_sessions(F.col("s"), F.lit("14:00"), F.lit("16:00")), d=sessions.session_doubts(F.col("s")))
    assert [tuple(x) for x in got[0][0]] == [(D(0), "02:30", "16:00"), (D(7), "14:00", "17:00"), (D(14), None, "16:00")] and got[0][1] == ["Hora de inicio no reconocida: late"]
    assert got[1] == (None, []) and got[2] == (None, [])


def test_events_follow_their_sessions(spark):
    at = lambda *days: [(D(n), "19:00", "21:00") for n in days]
    rows = [(1, D(3), None, "10:00", None, None, False, None, at(0, 7)), (2, D(3), None, "10:00", None, None, False, ["x"], at(0, 1, 2)), (3, D(3), None, "10:00", None, None, False, ["x"], at(0, 200)), (4, D(3), None, "10:00", None, None, False, None, None), (5, None, None, None, None, None, False, None, at(*range(0, 26, 2)))]
    events = spark.createDataFrame(rows, f"id int, date date, end_date date, start_time string, end_time string, weekday string, is_recurring boolean, doubts array<string>, sessions {SESSION}")
    got = {r["id"]: r for r in sessions.fit_sessions(events).collect()}
    assert (got[1]["date"], got[1]["end_date"], got[1]["start_time"], got[1]["weekday"], len(got[1]["sessions"])) == (D(0), D(7), "19:00", "domingo", 2)
    assert (got[2]["date"], got[2]["end_date"], got[2]["start_time"], got[2]["sessions"]) == (D(0), D(2), "10:00", None)
    assert got[3]["is_recurring"] and got[3]["doubts"] == ["x", sessions.COURSE_DOUBT] and got[3]["date"] == D(3) and got[5]["is_recurring"]
    assert tuple(got[4])[1:] == rows[3][1:]
    bad = [(at(0, 7), D(0), D(7)), (at(7, 0), D(7), D(0)), (at(0), D(0), D(0)), ([(None, None, None), (D(1), None, None)], None, D(1)), (at(0, 130), D(0), D(3)), (None, D(0), None)]
    found = of(spark, f"s {SESSION}, a date, b date", bad, p=sessions.series_problems(F.col("s"), F.col("a"), F.col("b")))
    assert [p for (p,) in found] == [[], ["out of order"], ["count"], ["day unknown"], ["too long", "days don't frame it"], []]


def test_posts_are_merged_in_order(spark):
    s = lambda *days: [(D(n), "18:00", None) for n in days]
    rows = [
        ("new day", 1, 1, "A", "10:00", "v", D(1), D(2), None), ("new day", 2, 2, "B", "11:00", None, D(9), None, None),
        ("older", 1, 5, "A", "10:00", None, D(1), None, None), ("older", 2, 3, "B", "11:00", "w", D(4), None, None), ("older", 3, 2, None, None, None, D(1), D(3), None),
        ("one of its days", 1, 1, "A", None, None, D(1), D(3), None), ("one of its days", 2, 2, "B", "11:00", None, D(2), None, None),
        ("completed", 1, 5, "A", "10:00", None, D(7), None, None), ("completed", 2, 3, "B", None, None, D(0), D(14), s(0, 7, 14)),
        ("no range", 1, 1, "A", None, None, D(1), D(3), None), ("no range", 2, 2, "A", None, None, D(9), D(30), None),
    ]
    posts = spark.createDataFrame(rows, f"e string, at int, seen int, title string, start_time string, venue string, date date, end_date date, sessions {SESSION}")
    got = {r["e"]: tuple(r)[1:6] + (r["sessions"] and len(r["sessions"]),) for r in merging.merged_in_order(posts, "e", "at", "seen", ["title", "start_time", "venue"]).collect()}
    assert got == {
        "new day": ("A", "11:00", "v", D(9), None, None), "older": ("A", "10:00", "w", D(1), D(3), None), "one of its days": ("A", None, None, D(1), D(3), None),
        "completed": ("A", "18:00", None, D(0), D(14), 3), "no range": ("A", None, None, D(9), None, None),
    }


def test_rules_on_readings(spark):
    said = ["Nos vemos en Tunja", "Maestro que llega de Cali", "Cali Pachanguero en vivo", "De Lima a Bogotá", "Gira: Buenos Aires"]
    assert [c for (c,) in of(spark, "t string", [(x,) for x in said], c=merging.city(F.lit("yes"), F.lit(None).cast("string"), F.col("t")))] == ["unknown", "yes", "yes", "yes", "unknown"]
    assert [c for (c,) in of(spark, "k string, t string", [("social", "Noche de son"), ("social", "Gran SOCIAL"), ("concert", "x")], c=merging.kind_at_a_bar(F.col("k"), F.col("t")))] == ["party", "social", "concert"]
    prices = [[("VIP", 0, "80 USD"), ("General", 30000, None), (" ", 5, None), ("Mesa", -1, None), ("Entrada libre", 0, "antes 10 eur"), ("Palco", 0, "€40"), ("Puerta", 0, None)]]
    ((got,),) = of(spark, "p array<struct<label:string,amount_cop:int,condition:string>>", [(p,) for p in prices], c=merging.clean_prices(F.col("p")))
    assert [p["label"] for p in got["prices"]] == ["General", "Entrada libre", "Puerta"] and got["doubts"] == ["Precio en otra moneda: VIP (80 USD)", "Precio en otra moneda: Palco (€40)"]


def test_labels(spark):
    assert [x for (x,) in of(spark, "p array<int>", [([50000, 20000],), ([0, 5],), ([1234567],), ([],), (None,)], x=labels.price_label(F.col("p")))] == ["Desde $ 20.000", "Gratis", "$ 1.234.567", None, None]
    assert of(spark, "a int, b int", [(3, 1), (0, 0), (1, 2)], x=labels.counted((F.col("a"), "nuevo", "nuevos"), (F.col("b"), "unido", "unidos"))) == [("3 nuevos, 1 unido",), ("",), ("1 nuevo, 2 unidos",)]
    assert of(spark, "x double", [(1234.56,), (-0.5,)], x=labels.decimal(F.col("x"))) == [("1.234,6",), ("-0,5",)]
    assert [x for (x,) in of(spark, "v string", [("6",), ("6.0",), ("10.1",), ("0",)], x=labels.version(F.col("v")))] == [[6], [6], [10, 1], []]
    assert [tuple(x) for (x,) in of(spark, "h string", [("@Salsa.Club ",), ("salsa_cl…",), ("dos palabras",), (None,)], x=labels.read_handle(F.col("h")))] == [("salsa.club", False), ("salsa_cl", True), (None, False), (None, False)]
    assert of(spark, "t string", [("21:05",), ("x",)], x=labels.minutes(F.col("t"))) == [(1265,), (None,)]


def test_filters(spark):
    moments = [("2026-11-01 20:00:00",), ("2026-11-01 19:59:59",), ("2026-11-01 21:44:59",), ("2026-11-01 21:45:00",), ("2026-11-01 23:30:00",)]
    assert [x for (x,) in of(spark, "t string", moments, x=filters.near_slot(F.col("t").cast("timestamp"), ["21:00", "00:15"]))] == [True, False, True, False, True]
    media = [[("VIDEO", 9), ("IMAGE", 1), ("STORY", 8), ("CAROUSEL", 3)]]
    assert [[tuple(m) for m in x] for (x,) in of(spark, "m array<struct<media_type:string,published:int>>", [(m,) for m in media], x=filters.ordered_media(F.col("m")))] == [[("CAROUSEL", 3), ("IMAGE", 1), ("VIDEO", 9), ("STORY", 8)]]
    kept, lost = filters.publishable(spark.createDataFrame([(1, "a", []), (1, "b", ["y", "x"]), (1, "c", ["x"]), (2, "d", [])], "post int, id string, why array<string>"), "post", "why")
    assert {r["id"] for r in kept.collect()} == {"a", "d"} and [tuple(r) for r in lost.collect()] == [(1, ["x", "y"])]
    now = F.lit("2026-11-20 00:00:00").cast("timestamp")
    assert [x for (x,) in of(spark, "p string, f boolean", [("2026-11-13 00:00:00", False), ("2026-11-12 23:00:00", False), ("2026-11-01 00:00:00", True)], x=filters.within_lookback(F.col("p").cast("timestamp"), now, F.col("f")))] == [True, False, True]
