"""Every query of the library against its SQL, and small cases of the operators that the tables don't show."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from heraldo.functions import dates, text
from heraldo.operators import matching, series, state
from heraldo.plans import catalogue

from .conftest import SMALL


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_gives_the_rows_of_its_sql(name, same):
    same(catalogue.QUERIES[name], catalogue.ORACLE_SQL[name])


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("x"))).collect()]


def test_dates_and_times_are_real_or_null(spark):
    assert column(spark, ["2026-02-28", "2026-02-30", " 2026-01-05 ", "soon", None], text.iso_date) == [dt.date(2026, 2, 28), None, dt.date(2026, 1, 5), None, None]
    assert column(spark, ["9:05", "21:00", "24:00", "9:60", "", None], text.clock) == ["09:05", "21:00", None, None, None, None]


def test_fold_and_slug(spark):
    assert column(spark, ["  Salsa  CALEÑA ", "Straße", None], text.fold) == ["salsa calena", "strasse", None]
    odd = ["Šokolāda", "𝗦𝗔𝗟𝗦𝗔 𝟐𝟎𝟐𝟔", "ﬁesta ﬀ", "Ｂａｃｈａｔａ", "ñandú ①", "Ørsted"]
    assert column(spark, odd, text.fold) == column(spark, odd, text.fold_any)
    assert column(spark, ["𝗦𝗔𝗟𝗦𝗔 Única", None], text.fold_any) == ["salsa unica", None]
    assert column(spark, ["Noche de ¡Fiesta!", "a" * 60, "word " * 12], text.slug) == ["noche-de-fiesta", "a" * 50, "-".join(["word"] * 10)]


def test_contacts(spark):
    given = ["@academia", "www.baile.co/x", "WhatsApp: 300 123 4567", "3001234567", "SOCIAL", ""]
    assert column(spark, given, text.contact) == ["@academia", "www.baile.co/x", "WhatsApp 300 123 4567", "3001234567", None, None]


def test_weekends(spark):
    days = [dt.date(2026, 10, d) for d in (5, 8, 9, 10, 11, 12)]  # a Monday, a Thursday, a Friday to Sunday, a Monday
    fridays = column(spark, days, lambda c: dates.weekend(c)["first"], "date")
    assert fridays == [dt.date(2026, 10, 9)] * 5 + [dt.date(2026, 10, 16)]


def test_hashes_that_lie_close(spark):
    rows = spark.createDataFrame([(1, 0, 0), (2, 0, 0b1111), (3, 0, -1), (4, 1, 0)], "k long, block long, bits long")
    assert [tuple(r) for r in matching.close_hashes(rows, "k", "block", "bits", 10).collect()] == [(1, 2, 4)]


def test_hashes_within_twenty_bits_are_found(spark):
    assert catalogue.QUERIES["near_dup_hamming"](spark, SMALL).count() == 25
    rows = spark.createDataFrame([(1, 0, 0), (2, 0, int("1001" * 10, 2)), (3, 0, int("1001" * 10, 2) << 1), (4, 0, (1 << 21) - 1)], "k long, block long, bits long")
    assert (1, 2, 20) in [tuple(r) for r in matching.close_hashes(rows, "k", "block", "bits", 20).collect()]


def test_greedy_claims_are_exclusive_and_in_order(spark):
    pairs = spark.createDataFrame([(1, 1, 7, 5), (1, 1, 8, 4), (1, 2, 7, 9), (1, 3, 7, 9)], "g long, item long, answer long, score long")
    assert sorted(tuple(r) for r in matching.greedy_claims(pairs, "g", "item", "answer", "score").collect()) == [(1, 1, 7)]


def test_greedy_claims_fall_back(spark):
    pairs = spark.createDataFrame([(1, 1, 7, 5), (1, 2, 7, 9), (1, 2, 8, 1)], "g long, item long, answer long, score long")
    assert sorted(tuple(r) for r in matching.greedy_claims(pairs, "g", "item", "answer", "score").collect()) == [(1, 1, 7), (1, 2, 8)]


def test_streak_of_an_empty_table_and_of_nulls(spark):
    rows = spark.createDataFrame([(1, 1, True), (1, 2, None), (1, 3, True), (2, 1, False)], "k long, at long, yes boolean")
    assert sorted(tuple(r) for r in series.latest_streak(rows, ["k"], ["at"], F.col("yes")).collect()) == [(1, 1), (2, 0)]
    assert series.latest_streak(rows.where("false"), ["k"], ["at"], F.col("yes")).collect() == []


def test_archive_rewrites_only_the_years_that_change(spark, tmp_path):
    path = str(tmp_path / "archive")
    rows = lambda *r: spark.createDataFrame(r, "id long, v long, day date")
    state.write_archive(rows((1, 1, dt.date(2025, 1, 1)), (2, 1, dt.date(2026, 1, 1))), None, path, ["id"], ["v"], "day")
    stored = spark.createDataFrame(spark.read.parquet(path).collect(), spark.read.parquet(path).schema)
    state.write_archive(rows((2, 2, dt.date(2026, 5, 1))), stored, path, ["id"], ["v"], "day")
    assert sorted((r["id"], r["v"]) for r in spark.read.parquet(path).collect()) == [(1, 1), (2, 2)]


def test_numbered_ids(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "k long, b string")
    assert sorted(r["id"] for r in state.numbered_ids(rows, F.col("b"), ["k"]).collect()) == ["a", "a-2", "b"]
