"""Days in text, date labels and accounts on small cases that the tables don't show."""

import datetime as dt
import difflib
import random

from pyspark.sql import functions as F

from heraldo.functions import labels, resolve
from heraldo.operators import reconcile
from heraldo.plans import resolved

from .conftest import SMALL

MONDAY = dt.date(2026, 10, 5)


def on_monday(spark, texts, f):
    rows = spark.createDataFrame([(i, t, MONDAY) for i, t in enumerate(texts)], "i int, x string, p date")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("x"), F.col("p"))).collect()]


def test_days_named_with_their_weekday(spark):
    d = lambda m, n: dt.date(2026, m, n)
    cases = {
        "MIÉRCOLES 14 de octubre con banda": [d(10, 14)], "Lunes 12, también vie. 16": [d(10, 12), d(10, 16)], "lunes 13 de octubre": [], "domingo 7:45": [], "jueves 9 am": [], "martes 7 de la tarde": [],
        "Matrículas hasta el lunes 12": [], "Escríbenos antes del martes 13": [], "jueves 15 cierra el plazo de pago": [], "concierto de cierre domingo 18": [d(10, 18)], "cierre de caja domingo 18": [],
        "baila hasta las 4\ndom 18 set": [], "dom 18 oct": [d(10, 18)], "viernes 8 de enero": [dt.date(2027, 1, 8)], "nada que decir": [], None: [], "": [], "martes": [],
    }
    assert dict(zip(cases, on_monday(spark, list(cases), resolve.weekday_dates), strict=True)) == cases


def test_days_named_by_the_day_of_the_post(spark):
    d = lambda n: dt.date(2026, 10, n)
    cases = {
        "Este martes 9 am": [[d(6)]], "este martes 20 hay ensayo": [], "qué rumba el domingo anterior": [], "gracias, este domingo que pasó": [], "Llega el próximo miércoles": [[d(7), d(14)]], "hoy lunes, mañana martes": [[d(5)], [d(6)]],
        "nos vemos este fin de semana": [[d(8), d(9), d(10), d(11)]], "ESTE FINDE\ny el jueves": [[d(8), d(9), d(10), d(11)], [d(8)]], "esta tarde": [], None: [],
    }
    assert dict(zip(cases, on_monday(spark, list(cases), resolve.relative_days), strict=True)) == cases
    dated = lambda x, p: resolve.relative_days(x, p, resolve.weekday_dates(x, p))
    assert on_monday(spark, ["Domingo 25 de octubre, gran final\nEste domingo bailamos"], dated) == [[[d(11), d(25)]]]


def test_printed_parts_become_a_day(spark):
    kind = "i int, weekday int, day int, month int, year int, relative string, end_day int, end_month int, weekly boolean, taken date, today date"
    given = [
        ((2, 14, 10, None, None, None, None), "2026-10-14", None, ["año deducido"]), ((None, 30, 9, None, None, 2, None), "2026-09-30", "2026-10-02", ["año deducido"]),
        ((None, 27, 9, None, None, None, None), "2027-09-27", None, ["año deducido", "más de 60 días adelante: revisar"]), ((6, 1, None, None, None, 3, None), "2026-11-01", "2026-11-03", ["mes deducido"]), ((3, None, None, None, None, None, None), "2026-10-08", None, ["fecha deducida del día de la semana"]),
        ((1, 9, 10, 2026, None, 8, None), "2026-10-09", None, ["dice martes, pero esa fecha es viernes"]), ((None, 31, 11, None, None, None, None), None, None, []), ((None, None, None, None, "hoy", 6, 10), "2026-10-05", "2026-10-06", []), ((None,) * 7, None, None, []),
        ((None, 30, 12, 2026, None, 2, 1), "2026-12-30", "2027-01-02", ["más de 60 días adelante: revisar"]), ((None, 9, 10, 2026, None, 9, None), "2026-10-09", None, []), ((None, 9, 10, 2026, None, 16, 10), "2026-10-09", None, []),
    ]
    rows = spark.createDataFrame([(i, *parts[:5], *parts[5:], False, MONDAY, MONDAY) for i, (parts, *_) in enumerate(given)], kind)
    named = [F.col(c) for c in ("weekday", "day", "month", "year", "relative", "weekly", "taken", "today", "end_day", "end_month")]
    found = rows.orderBy("i").select(resolve.resolved_date(*named).alias("f")).select("f.*").collect()
    assert [(r.date and str(r.date), r.last and str(r.last), r.notes) for r in found] == [tuple(x[1:]) for x in given]
    weekly = spark.createDataFrame([(4, dt.date(2026, 9, 1), MONDAY)], "w int, taken date, today date").select(resolve.resolved_date(F.col("w"), *[F.lit(None).cast("int")] * 3, F.lit(None).cast("string"), F.lit(True), F.col("taken"), F.col("today")).alias("f"))
    assert [(str(r.date), r.notes) for r in weekly.select("f.*").collect()] == [("2026-10-09", ["fecha deducida del día de la semana", "semanal: publiqué la próxima fecha"])]


def test_printed_sessions_become_a_series(spark):
    """(sessions as (month, day), month, year, weekday, taken) and the days, places and notes."""
    year = "año deducido"
    given = [
        ([(11, 8), (11, 22), (None, 29), (None, 6)], None, None, 6, "2026-10-05", ["2026-11-08", "2026-11-22", "2026-11-29", "2026-12-06"], [0, 1, 2, 3], [year]),
        ([(9, 6), (9, 20), (10, 11)], None, None, None, "2026-10-05", ["2026-09-06", "2026-09-20", "2026-10-11"], [0, 1, 2], [year]),
        ([(12, 27), (1, 3), (None, 10)], None, None, None, "2026-12-01", ["2026-12-27", "2027-01-03", "2027-01-10"], [0, 1, 2], [year]),
        ([(1, 4), (1, 11)], None, None, None, "2026-10-05", ["2027-01-04", "2027-01-11"], [0, 1], [year, "más de 60 días adelante: revisar"]),
        ([(None, 20), (None, 27), (None, 3)], None, None, None, "2026-10-05", ["2026-10-20", "2026-10-27", "2026-11-03"], [0, 1, 2], ["mes deducido", year]),
        ([(None, 20), (None, 27)], 11, 2026, None, "2026-10-05", ["2026-11-20", "2026-11-27"], [0, 1], []),
        ([(11, 3), (11, 10)], None, None, 5, "2026-10-05", ["2026-11-03", "2026-11-10"], [0, 1], [year, "dice sábado, pero el 3 es martes"]),
        ([(10, 3), (10, 10)], None, None, 6, "2026-10-11", ["2027-10-03", "2027-10-10"], [0, 1], [year, "más de 60 días adelante: revisar"]),
        ([(11, 8), (11, 8), (13, 1), (11, 15)], None, 2026, None, "2026-10-05", ["2026-11-08", "2026-11-15"], [0, 3], []),
        ([(2, 20), (2, 29)], None, None, None, "2027-01-05", ["2027-02-20", "2028-02-29"], [0, 1], [year]),
        ([(11, 8)], None, None, None, "2026-10-05", None, None, None), ([(11, 8), (11, 8)], None, None, None, "2026-10-05", None, None, None), ([(11, 31), (12, 1)], None, None, None, "2026-10-05", None, None, None), (None, None, None, None, "2026-10-05", None, None, None),
        ([(3, 1), (3, 8)], None, 2020, None, "2026-10-05", ["2020-03-01", "2020-03-08"], [0, 1], []),
    ]
    rows = spark.createDataFrame([(i, s, m, y, w, dt.date.fromisoformat(t)) for i, (s, m, y, w, t, *_) in enumerate(given)], "i int, s array<struct<month:int,day:int>>, m int, y int, w int, t date")
    found = rows.orderBy("i").select(resolve.resolved_series(*[F.col(c) for c in "smywt"]).alias("f")).select("f.*").collect()
    assert [(r.days and [str(d) for d in r.days], r.places, r.notes) for r in found] == [tuple(x[5:]) for x in given]


def test_labels_of_days(spark):
    rows = spark.createDataFrame([(1, dt.date(2026, 10, 31), dt.date(2026, 11, 2)), (2, dt.date(2026, 11, 13), dt.date(2026, 11, 15)), (3, dt.date(2026, 12, 30), dt.date(2027, 1, 1)), (4, dt.date(2026, 1, 1), None), (5, None, None)], "i int, a date, b date")
    assert [r[0] for r in rows.orderBy("i").select(labels.dates_label(F.col("a"), F.col("b"))).collect()] == ["31 oct – 2 nov 2026", "13–15 nov 2026", "30 dic 2026 – 1 ene 2027", "2026-01-01", "?"]
    days = spark.createDataFrame([(1, [dt.date(2026, 11, n) for n in (8, 22, 29)] + [dt.date(2026, 12, 6)]), (2, [dt.date(2026, 12, 29), dt.date(2027, 1, 5)])], "i int, d array<date>")
    assert [r[0] for r in days.orderBy("i").select(labels.sessions_label(F.col("d"))).collect()] == ["4 sesiones: 8, 22, 29 nov y 6 dic", "2 sesiones: 29 dic 2026 y 5 ene 2027"]


def test_known_accounts_against_the_closest_spelling(spark):
    rng = random.Random(7)
    accounts = sorted({"".join(rng.choice("abco._") for _ in range(rng.randint(1, 16))) for _ in range(150)} | {"salsa_bogota", "salsa_bta"})
    misread = [a[:i] + rng.choice("abcx") + a[i + rng.randint(0, 1) :] for a in accounts for i in [rng.randrange(len(a))]]
    read = [(n, False) for n in misread] + [(a[: rng.randint(1, len(a))], True) for a in accounts] + [(None, False), ("zzz", True)]
    want = set()
    for name, cut in set(read):
        if name is None:
            continue
        begun = [a for a in accounts if a.startswith(name)]
        close = difflib.get_close_matches(name, accounts, n=1, cutoff=reconcile.CLOSE_SPELLING)
        found = (begun if len(begun) == 1 else []) if cut else close
        want |= {(name, cut, a) for a in found}
    got = reconcile.known_account(spark.createDataFrame(read, "name string, cut boolean"), spark.createDataFrame([(a.upper(),) for a in accounts], "account string")).collect()
    assert len(got) == len(want) > 50 and {tuple(r) for r in got} == want


def test_discovery_order(spark):
    rows = spark.createDataFrame([(1, "no", True, 9), (2, "yes", False, 5), (3, "unknown", True, None), (4, "yes", True, 1), (5, "yes", True, 3)], "position int, in_city string, announces boolean, followers int")
    assert [r.position for r in reconcile.discovery_order(rows).collect()] == [5, 4, 2, 3, 1]


def test_queries_find_something(spark):
    for name, column in (("weekday_dates", "days"), ("relative_days", "days"), ("styles_in_text", "styles")):
        kinds = {r[column] != "" for r in resolved.QUERIES[name](spark, SMALL).collect()}
        assert kinds == {True, False}
    assert resolved.QUERIES["repeats_earlier"](spark, SMALL).count() > 0 and resolved.QUERIES["one_identity"](spark, SMALL).count() > 0
