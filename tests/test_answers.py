"""Cancellations in texts, and answers given back to their posts."""

import pytest
from pyspark.sql import functions as F

from heraldo.functions import text
from heraldo.functions.cancellation import says_cancelled
from heraldo.operators import answers

OFF = [
    "Aviso: la clase del jueves queda APLAZADA. Nos vemos pronto",
    "Última hora\nSe suspende la milonga por falta de luz",
    "Se cancela por el paro; si reservaste, tu cupo sigue en pie",
    "Con pena, postergamos el campamento",
    "Nos vimos obligados a reprogramar la muestra!",
    "Cover: se cancela la rumba",
    "Tonight's class was cancelled",
    "Se cancela el día de mañana",
    "Si bien llovió poco, suspendemos la práctica",
    "La velada no se llevará a cabo",
    "¿Vienes? El concierto fue pospuesto",
]
ON = [
    None,
    "",
    "El valor se cancela en taquilla",
    "Aporte 35k. Se cancela el día de la función",
    "Se cancela a 25.000 por persona",
    "Se cancelan solo 40 mil pesos",
    "Ya se canceló tu inscripción",
    "La práctica no fue suspendida",
    "Ni se aplaza ni se suspende",
    "Si no hay quórum, la clase se pospone",
    "Se reprograma en caso de tormenta",
    "Se suspende si falla el sonido",
    "¿Se aplaza la velada?",
    "Cancelaciones hasta el lunes",
    "La mensualidad de mayo se cancela por Nequi",
]


@pytest.mark.parametrize(("texts", "off"), [(OFF, True), (ON, False)])
def test_cancellations(spark, texts, off):
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", says_cancelled(F.col("t")).alias("off")).collect()
    assert [r["t"] for r in rows if r["off"] != off] == []


def test_contacts(spark):
    cases = {"@la.sala_1": "@la.sala_1", "@con espacio": None, "sala.com.co/agenda?x=1": "sala.com.co/agenda?x=1", "https://sala.co": "https://sala.co", "www..co": None, "Wasap: +57 300 123 4567": "WhatsApp +57 300 123 4567", "whats app 3001234567": "WhatsApp 3001234567", "tel (601) 555-1234": "(601) 555-1234", "ext 123": None, "": None}
    rows = spark.createDataFrame([(k, v) for k, v in cases.items()], "t string, want string").select("t", "want", text.contact(F.col("t")).alias("got")).collect()
    assert [(r["t"], r["got"]) for r in rows if r["got"] != r["want"]] == []


def test_answers_go_back_to_their_posts(spark):
    posts = [(1, 0, 2), (1, 1, 1), (1, 2, 0), (1, 3, 1), (1, 4, 1), (2, 0, 1)]
    told = [
        (1, " post a", True, "x", [("A", 1), ("B", None)]),
        (1, "B", True, "y", [("C", 2)]),
        (1, "C", True, "z", [("D", 0)]),
        (1, "D", False, "w", [("E", 3)]),
        (2, "A", True, "v", [("F", 0)]),
        (2, "Q", True, "u", [("G", 0)]),
    ]
    got = answers.split_answers(
        spark.createDataFrame(posts, "request int, place int, images int"),
        spark.createDataFrame(told, "request int, post string, is_event_post boolean, reason string, events array<struct<title:string,image_index:int>>"),
    )
    rows = {(r["request"], r["place"]): (r["left_out"], r["events"] and [tuple(e) for e in r["events"]]) for r in got.collect()}
    assert rows == {
        (1, 0): (None, [("A", 1), ("B", None)]),
        (1, 1): (None, [("C", 0)]),
        (1, 2): (answers.OTHER_IMAGE, None),
        (1, 3): (answers.NO_EVENT, None),
        (1, 4): (answers.NONE, None),
        (2, 0): (answers.STRAY, None),
    }


def test_two_answers_and_no_rows(spark):
    posts = spark.createDataFrame([(1, 0, 1)], "request int, place int, images int")
    twice = spark.createDataFrame([(1, "A", True, "", [("x", 0)])] * 2, "request int, post string, is_event_post boolean, reason string, events array<struct<title:string,image_index:int>>")
    assert [r["left_out"] for r in answers.split_answers(posts, twice).collect()] == [answers.TWO]
    assert [r["left_out"] for r in answers.split_answers(posts, twice.where("false")).collect()] == [answers.NONE]
