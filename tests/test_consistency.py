"""Days and hours in text, and the eight rules that hold a reading against it."""

import datetime as dt

import pytest

from heraldo.functions import mentions
from heraldo.operators import consistency as c

WEDNESDAY = dt.date(2026, 10, 7)
SCHEMA = f"i int, caption string, published date, events array<{c.EVENT}>"


def event(day="2026-10-10", end=None, start="20:00", kind="workshop", recurring=False, sessions=None):
    real = lambda x: x and dt.date.fromisoformat(x)
    return {"date": real(day), "end_date": real(end), "start_time": start, "event_type": kind, "is_recurring": recurring, "sessions": [{"date": real(s)} for s in sessions] if sessions else None}


def flags(spark, cases):
    rows = spark.createDataFrame([(i, t, p, e) for i, (t, e, p) in enumerate(cases)], SCHEMA)
    return [r.flags for r in c.flagged(rows).orderBy("i").collect()]


def times(text):
    found = mentions.scan(text)
    return found["starts"], found["times"]


@pytest.mark.parametrize("text, starts, every", [
    ("Abrimos 5 pm, banda 9:15P.M y 1 a.m.", ["01:00", "17:00", "21:15"], None),
    ("10:00 AM A 12:00 M", ["10:00"], ["10:00", "12:00"]),
    ("de 7 a 9 pm", ["19:00"], ["19:00", "21:00"]),
    ("rumba de 10 a 3 am", ["22:00"], ["03:00", "22:00"]),
    ("clase 8pm. a 11:30 pm\nbaile 11:30 pm a 4 am", ["20:00", "23:30"], ["04:00", "20:00", "23:30"]),
    ("desde las 3PM hasta las 9PM", ["15:00"], ["15:00", "21:00"]),
    ("19h45 y 22h, curso de 2h y 3 hrs", ["19:45", "22:00"], None),
    ("7 de la mañana, 4 de la tarde, 9 de la noche, 12 de la noche", ["00:00", "07:00", "16:00", "21:00"], None),
    ("almuerzo al mediodía, hasta la medianoche", ["12:00"], ["00:00", "12:00"]),
    ("gratis antes de las 9 pm, cerramos a las 2 am, show a las 10 pm", ["22:00"], ["02:00", "21:00", "22:00"]),
    ("cierre de cupos 11:59 pm", [], []),
    ("Calle 45 #7-20, $35.000, tel 310 555 1234, 2 HORAS", [], []),
    ("18:40", ["18:40"], None), ("27:10 horas", [], []), ("", [], []),
])
def test_clock_times(text, starts, every):
    assert times(text) == (starts, starts if every is None else every)


@pytest.mark.parametrize("text, dates, ranges, lists", [
    ("5 de junio", [(5, 6)], [], []), ("5DEJUNIO", [(5, 6)], [], []), ("junio 5", [(5, 6)], [], []), ("JUN. 5", [(5, 6)], [], []),
    ("MAR 5", [], [], []), ("5 MAR", [(5, 3)], [], []), ("1ro de mayo", [(1, 5)], [], []), ("1° mayo y primero de julio", [(1, 5), (1, 7)], [], []),
    ("5/6", [(5, 6)], [], []), ("5/06/2026", [(5, 6)], [], []), ("5-6-26 y 5.6.2026", [(5, 6), (5, 6)], [], []), ("24/7", [], [], []), ("8.30 y 9.15", [], [], []), ("3/4/5/6", [], [], []),
    ("del 4 al 7 de mayo", [(7, 5)], [(7, 5)], []), ("28 ABR — 02 MAY", [(28, 4), (2, 5)], [(2, 5)], []), ("mayo 4 al 7", [(4, 5)], [(7, 5)], []), ("May 4-7", [(4, 5)], [(7, 5)], []), ("May 4 - 7:30", [(4, 5)], [], []),
    ("desde el 4 hasta el 7 de mayo", [(7, 5)], [(7, 5)], []), ("6 & 7 de mayo", [(7, 5)], [(7, 5)], []), ("2 y 9 de mayo", [(9, 5)], [], []),
    ("2, 9 y 16 de mayo", [(16, 5)], [], [([2, 9, 16], 5)]), ("2 · 9 · 16 MAY", [(16, 5)], [], [([2, 9, 16], 5)]), ("2 y el 9 de mayo", [(9, 5)], [], [([2, 9], 5)]), ("2, 9, 16", [], [], []),
    ("Del 4 al 7 de mayo: $40.000", [(7, 5)], [], []), ("Del 4 al 7 de mayo 40 mil", [(7, 5)], [], []), ("Inscripciones del 4 al 7 de mayo", [(7, 5)], [], []), ("Gala | valor $9 | del 4 al 7 de mayo", [(7, 5)], [(7, 5)], []),
    ("Cra 7 #3-4\n5 de mayo", [(5, 5)], [], []), ("31 de 2026", [], [], []), ("45 de mayo", [], [], []),
])
def test_days_in_text(text, dates, ranges, lists):
    found = mentions.scan(text)
    pairs = lambda xs: [(x["day"], x["month"]) for x in xs]
    assert (pairs(found["dates"]), pairs(found["ranges"]), [(x["days"], x["month"]) for x in found["lists"]]) == (dates, ranges, lists)


def test_each_rule_with_and_without_the_day_of_the_post(spark):
    sessions = ["2026-10-03", "2026-10-10", "2026-10-17"]
    cases = [
        # a date, and nothing read or only what recurs
        ("Ciclo los 3, 10 y 17 de octubre", [], None, [c.DATES_WITHOUT_EVENT]), ("Banda el jueves 8 de octubre", [event(recurring=True)], None, [c.DATES_WITHOUT_EVENT]), ("Práctica cada lunes", [], None, []),
        ("Qué noche la del 2 de octubre", [], WEDNESDAY, []), ("Volvemos el 23 de octubre", [], WEDNESDAY, [c.DATES_WITHOUT_EVENT]), (None, None, WEDNESDAY, []),
        # an hour, and an event without one
        ("Taller 7:20 pm", [event(start=None)], None, [c.TIME_NOT_READ]), ("Taller 7:20 pm", [event(start="")], None, [c.TIME_NOT_READ]), ("Taller 7:20 pm", [event(start="19:20")], None, []),
        ("Talleres 9 am", [event(end="2026-10-12", start=None)], None, []), ("Talleres 9 am", [event(start=None, sessions=sessions)], None, [c.TIME_NOT_READ]),
        # a range whose last day nothing takes
        ("28 OCT — 02 NOV", [event()], None, [c.RANGE_AS_ONE_DAY]), ("28 OCT — 02 NOV", [event(end="2026-11-02")], None, []), ("28 OCT — 02 NOV", [event("2026-10-28")], WEDNESDAY, [c.RANGE_AS_ONE_DAY]),
        ("9 y 10 de octubre", [event("2026-10-09"), event("2026-10-10")], WEDNESDAY, []), ("30 y 31 de noviembre", [event()], WEDNESDAY, []),
        # three hours, one event
        ("3:00 pm lady style\n4:00 pm salsa\n5:00 pm bachata", [event(start="15:00")], None, [c.TIMES_OVER_EVENTS]), ("3 pm lady style\n4 pm salsa\n5 pm bachata", [event(start="15:00", kind="social")], None, []),
        ("3 pm, 4 pm y 5 pm", [event(start="15:00"), event(start="16:00")], None, []), ("Clase 6 pm · baile 9:30 pm\n9:30", [event(start="18:00")], None, []), ("3 pm, 4 pm y 5 pm", [event(kind=None)], None, [c.TIMES_OVER_EVENTS]),
        # a list with a day that nothing takes
        ("3, 10 y 17 de octubre", [event()], None, [c.LIST_NOT_READ]), ("3, 10 y 17 de octubre", [event(sessions=sessions)], None, []), ("3, 10 y 17 de octubre", [event()], WEDNESDAY, [c.LIST_NOT_READ]),
        ("12, 13, 14 y 15 de noviembre", [event("2026-11-12", "2026-11-15")], WEDNESDAY, []),
        # a weekday with its day
        ("Jueves 8 de octubre: son\nSábado 10 de octubre: timba", [event()], WEDNESDAY, [c.DAY_WITHOUT_EVENT]), ("VIE 9 OCT", [event("2026-10-09")], WEDNESDAY, []), ("Domingo 9 de octubre", [event()], WEDNESDAY, []),
        ("Gala de cierre viernes 9", [event()], WEDNESDAY, [c.DAY_WITHOUT_EVENT]), ("Cierre de cupos viernes 9", [event()], WEDNESDAY, []), ("Viernes 9 de octubre, 7 pm hasta las 2 am", [event()], WEDNESDAY, [c.DAY_WITHOUT_EVENT]),
        # a day named by the day of the post
        ("Este sábado a las 5PM", [event("2026-10-17")], WEDNESDAY, [c.RELATIVE_WITHOUT_EVENT]), ("Este sábado a las 5PM", [event()], WEDNESDAY, []), ("Hoy miércoles", [event("2026-10-07")], WEDNESDAY, []),
        ("Mañana jueves", [event("2026-10-15")], WEDNESDAY, [c.RELATIVE_WITHOUT_EVENT]), ("El viernes pasado fue único", [event()], WEDNESDAY, []),
        ("Sábado 31 de octubre, disfraces\nEste sábado los esperamos", [event("2026-10-31")], WEDNESDAY, []), ("Este finde", [event("2026-10-11")], WEDNESDAY, []),
        # over before it was announced
        ("", [event("2026-10-01")], WEDNESDAY, [c.BEFORE_POST]), ("", [event("2026-10-01", "2026-10-07")], WEDNESDAY, []), ("", [event(None)], WEDNESDAY, []),
        # several at once, in order
        ("Jueves 8 de octubre\n8, 15 y 22 de octubre, 6 pm, 7 pm, 8 pm", [event("2026-09-01", start=None)], WEDNESDAY, [c.TIME_NOT_READ, c.TIMES_OVER_EVENTS, c.LIST_NOT_READ, c.DAY_WITHOUT_EVENT, c.BEFORE_POST]),
    ]
    found = flags(spark, [case[:3] for case in cases])
    for case, own in zip(cases, found, strict=True):
        assert own == case[3], case


def test_empty_table_and_long_text(spark):
    assert c.flagged(spark.createDataFrame([], SCHEMA)).collect() == []
    (own,) = flags(spark, [("texto sin nada, " * 20_000 + "8 de noviembre", [], WEDNESDAY)])
    assert own == [c.DATES_WITHOUT_EVENT]
