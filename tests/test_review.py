"""Reasons for a second look at an event."""

import datetime as dt

from pyspark.sql import functions as F

from heraldo.operators import review


def test_reasons_and_events_to_review(spark):
    day, gone = dt.date(2026, 10, 10), dt.date(2026, 10, 1)
    rows = [
        (1, "high", [], "party", day, None), (2, "high", ["El DÍA no es claro", "precio"], "party", day, None), (3, "high", ["precio"], "party", day, None), (4, "low", None, "party", day, None),
        (5, "high", None, "congress", day, None), (6, "high", ["quizás aplazado"], "festival", day, day), (7, "low", ["x"], "party", gone, None), (8, "low", ["x"], "congress", gone, day), (9, None, ["x"], None, day, None),
    ]
    events = spark.createDataFrame(rows, "id int, confidence string, doubts array<string>, event_type string, date date, end_date date")
    twins = spark.createDataFrame([(1, "Noche"), (7, "Otra")], "id int, twin string")
    found = {r.id: r.reasons for r in review.to_review(events, twins, F.lit("2026-10-05").cast("date")).collect()}
    assert found == {
        1: ["¿el mismo evento que «Noche»?"], 2: ["El DÍA no es claro", "precio"], 4: [review.NO_DETAILS], 5: [review.SINGLE_DAY_DOUBT],
        6: ["quizás aplazado"], 8: ["x"], 9: ["x"],
    }
