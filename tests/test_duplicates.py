"""Events merged in input order, against the same fold written out over lists; references to those that went."""

import datetime as dt
import random

from heraldo.operators import duplicates

SESSIONS = "sessions array<struct<date:date,start_time:string,end_time:string>>"
FIELDS = ["title", "event_type", "venue", "start_time", "end_time", "date", "end_date", "sessions"]
EVENT = f"id string, pos int, account string, posts array<string>, seen int, title string, event_type string, venue string, start_time string, end_time string, date date, end_date date, {SESSIONS}"
DAY = dt.date(2026, 10, 10)
TITLES = ["Ocaso", "Ocaso Lunar", "Ocaso Lunar Ribera", "Lunar Ribera", "Ribera", "Brisa"]


def event(id, pos, title="Ocaso", venue=None, start=None, date=DAY, end=None, posts=None, account="uno", sessions=None, kind="social", seen=None):
    return (id, pos, account, [f"p{id}"] if posts is None else posts, pos if seen is None else seen, title, kind, venue, start, None, date, end, sessions)


def merge(spark, rows):
    found = duplicates.merge_duplicates(spark.createDataFrame(rows, EVENT), FIELDS)
    return sorted((r["id"], sorted(r["posts"]), r["seen"], r["title"], r["venue"], r["start_time"], r["date"], r["end_date"], r["dropped"]) for r in found.collect())


def by_hand(rows):
    """The same for events without sessions whose titles name no kind."""

    def days(e):
        return {e["date"] + dt.timedelta(i) for i in range(((e["end"] or e["date"]) - e["date"]).days + 1)} if e["date"] else set()

    def one(a, b):
        if a["account"] != b["account"] or not days(a) & days(b) or set(a["posts"]) & set(b["posts"]):
            return False
        x, y = (set(e["title"].split()) for e in (a, b))
        least = min(len(x), len(y))
        if a["end"] or b["end"]:
            return x == y or (len(x & y) >= 2 and len(x & y) >= 0.6 * least)
        if a["start"] and b["start"]:
            return a["start"] == b["start"]
        return x == y or (len(x & y) == least and not (a["venue"] and b["venue"] and a["venue"] != b["venue"]))

    def said(e):
        return sum(e[f] is not None for f in ("title", "kind", "venue", "start", "date", "end")), len(e["title"])

    def absorb(s, p):
        out, newest = dict(s), p["seen"] >= s["seen"]
        of_one_day = bool(s["end"]) and not p["end"] and p["date"] in days(s)
        out["venue"] = s["venue"] or p["venue"]
        if p["start"] and not of_one_day and (not s["start"] or newest):
            out["start"] = p["start"]
        if p["date"] and not of_one_day:
            if newest or not s["date"]:
                out["date"], out["end"] = p["date"], p["end"]
            elif not s["end"] and p["end"] and p["date"] == s["date"]:
                out["end"] = p["end"]
        return out | {"seen": max(s["seen"], p["seen"]), "posts": s["posts"] + p["posts"], "dropped": [*s["dropped"], p["id"], *p["dropped"]]}

    kept = []
    for id, _, account, posts, seen, title, kind, venue, start, _, date, end, _ in sorted(rows, key=lambda r: r[1]):
        e = {"id": id, "account": account, "posts": posts, "seen": seen, "title": title, "kind": kind, "venue": venue, "start": start, "date": date, "end": end, "dropped": []}
        at = next((i for i, k in enumerate(kept) if one(k, e)), None)
        if at is None:
            kept.append(e)
        else:
            kept[at] = absorb(kept[at], e) if said(kept[at]) >= said(e) else absorb(e, kept[at])
    return sorted((k["id"], sorted(k["posts"]), k["seen"], k["title"], k["venue"], k["start"], k["date"], k["end"], k["dropped"]) for k in kept)


def test_random_events_merge_as_by_hand(spark):
    pick = random.Random(7)
    rows = []
    for i in range(600):
        first = None if pick.random() < 0.05 else DAY + dt.timedelta(pick.randrange(60))
        end = first + dt.timedelta(pick.randrange(1, 4)) if first and pick.random() < 0.2 else None
        rows.append(event(str(i), i, pick.choice(TITLES), pick.choice([None, None, "Patio", "Solar"]), pick.choice([None, "20:00", "21:00"]), first, end, [f"p{pick.randrange(200)}"], pick.choice(["uno", "dos", "tres"]), seen=pick.randrange(300)))
    expected = by_hand(rows)
    assert sum(len(r[-1]) for r in expected) > 150 and max(len(r[-1]) for r in expected) >= 4
    assert any(a in r[-1] and r[-1].index(a) > 0 for r in expected for a in r[-1])
    assert merge(spark, rows) == expected


def test_the_fuller_event_takes_the_place_of_the_first(spark):
    rows = [event("a", 1), event("b", 2, venue="Patio", start="20:00"), event("c", 3, "Otra", start="20:00")]
    assert merge(spark, rows) == [("b", ["pa", "pb", "pc"], 3, "Ocaso", "Patio", "20:00", DAY, None, ["a", "c"])]


def test_a_series_absorbs_a_post_of_one_session(spark):
    later = DAY + dt.timedelta(7)
    course = event("s", 1, "Intensivo Brisa", end=later, sessions=[(DAY, "14:00", "16:00"), (later, "14:00", "16:00")], kind="workshop")
    found = merge(spark, [course, event("t", 2, "Brisa", start="14:00", date=later, kind="workshop"), event("u", 3, "Brisa", start="18:00", date=later, kind="workshop")])
    assert [(r[0], r[6], r[7], r[8]) for r in found] == [("s", DAY, later, ["t"]), ("u", later, None, [])]


def test_events_that_never_merge(spark):
    rows = [event("a", 1, posts=["p"]), event("b", 2, posts=["p", "q"]), event("c", 3, account="dos"), event("d", 4, date=None), event("e", 5, date=None), event("f", 6, account=None), event("g", 7, account=None), event("h", 8, "", date=DAY + dt.timedelta(1)), event("i", 9, None, date=DAY + dt.timedelta(2), posts=[])]
    assert [r[0] for r in merge(spark, rows)] == list("abcdefghi")
    assert merge(spark, rows[:0] or spark.createDataFrame([], EVENT).collect()) == []


def test_references_name_what_is_kept(spark):
    merged = spark.createDataFrame([("k", ["a", "b"]), ("m", [])], "id string, dropped array<string>")
    records = spark.createDataFrame([(1, ["b", "z", "k", "a"]), (2, []), (3, None), (4, ["m"])], "post int, ids array<string>")
    found = duplicates.rewritten(records, duplicates.renamed(merged), "post", "ids").collect()
    assert sorted((r.post, r.ids) for r in found) == [(1, ["k", "z"]), (2, []), (3, None), (4, ["m"])]
