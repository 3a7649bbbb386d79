"""Ids that a post's new readings keep, against choices made one after the other in plain Python."""

import datetime as dt
import random

from heraldo.operators import rereads

DDL = "post int, pos int, id string, date date, title string, start_time string, event_type string"
DAY = dt.date(2026, 10, 1)


def by_hand(readings, events):
    left = {}
    for e in sorted(events):
        left.setdefault(e[0], []).append(e)

    def fits(e, r):
        fold = lambda t: (t or "").lower()
        return (e[3] == r[3], fold(e[4]) == fold(r[4]), bool(e[5]) and e[5] == r[5], e[6] == r[6])

    best = {r: max((fits(e, r) for e in left.get(r[0], [])), default=(False,) * 4) for r in readings}
    out = set()
    for r in sorted(readings, key=lambda r: (tuple(not b for b in best[r]), r[1])):
        mine = left.get(r[0], [])
        at = max(range(len(mine)), key=lambda i: fits(mine[i], r), default=None)
        out.add((r[0], r[1], None if at is None else mine.pop(at)[2]))
    return out


def test_random_posts(spark):
    draw = random.Random(5)
    some = lambda post, n, named: [(post, i, f"{post}-{i}" if named else None, draw.choice([None, DAY, dt.date(2026, 10, 2)]), draw.choice(["Salsa", "SALSA", "Zouk", None]), draw.choice([None, "", "20:00", "21:00"]), draw.choice([None, "social", "taller"])) for i in range(n)]
    readings = [r for p in range(150) for r in some(p, draw.randrange(5), False)]
    events = [e for p in range(150) for e in some(p, draw.randrange(4), True)]
    found = rereads.kept_ids(spark.createDataFrame(readings, DDL), spark.createDataFrame(events, DDL), "post", "pos", "id").collect()
    assert len(found) == len(readings) and {tuple(r) for r in found} == by_hand(readings, events)


def test_an_event_listed_before_takes_no_id(spark):
    events = [(1, 0, "taller", DAY, "Taller", "18:00", "taller"), (1, 1, "social", DAY, "Social", "20:00", "social")]
    again = [(1, 0, None, DAY, "Concierto", "22:00", "concierto"), (1, 1, None, DAY, "Social", "20:00", "social"), (1, 2, None, DAY, "Taller", "18:00", "taller")]
    found = rereads.kept_ids(spark.createDataFrame(again, DDL), spark.createDataFrame(events, DDL), "post", "pos", "id")
    assert {tuple(r) for r in found.collect()} == {(1, 0, None), (1, 1, "social"), (1, 2, "taller")}


def test_empty_tables(spark):
    none = spark.createDataFrame([], DDL)
    one = spark.createDataFrame([(1, 0, "a", DAY, "x", None, None)], DDL)
    assert rereads.kept_ids(none, one, "post", "pos", "id").collect() == []
    assert [tuple(r) for r in rereads.kept_ids(one, none, "post", "pos", "id").collect()] == [(1, 0, None)]
