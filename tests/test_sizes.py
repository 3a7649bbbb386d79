"""Steps whose work once grew faster than their input: results on awkward rows, and the shape of their plans."""

import datetime as dt
from itertools import combinations

from pyspark.sql import functions as F

from heraldo.functions import mentions
from heraldo.operators import matching, reconcile
from heraldo.plans import entities


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shared_by_hand(rows):
    sets = {}
    for k, m in rows:
        if k is not None:
            sets.setdefault(k, set()).add(m)
    return sorted((a, b, n, len(sets[a]), len(sets[b])) for a, b in combinations(sorted(sets), 2) if (n := len((sets[a] & sets[b]) - {None})))


def test_sets_of_common_members_are_compared_once_a_pair(spark):
    days = [dt.date(2026, 1, 1) + dt.timedelta(d) for d in range(90)]
    rows = [(k, days[d]) for k in range(40) for d in range(90) if (k * 7 + d * d) % 11 < 6] + [(3, None), (4, None), (None, days[0]), (90, None), (5, days[0]), (5, days[0])]
    found = matching.shared_members(spark.createDataFrame(rows, "k long, day date"), "k", "day")
    assert sorted(tuple(r) for r in found.collect()) == shared_by_hand(rows)
    assert "bit_count" in plan(found)  # pairs aren't listed once a shared member


def test_pairs_of_sets_are_stored_in_few_bytes(spark, tmp_path):
    import numpy as np
    import pyarrow.parquet as pq

    users = spark.range(2500 * 13).selectExpr("id % 2500 as user_id", "timestamp_ntz '2024-01-01' + make_dt_interval(cast(pmod(xxhash64(id), 30) as int)) as ts", "'purchase' as event_type")
    users.write.parquet(f"{tmp_path}/events.parquet")
    entities.session_set_overlap(spark, str(tmp_path)).write.parquet(f"{tmp_path}/pairs")
    bits = np.zeros(2500, np.uint64)
    for user, day in users.selectExpr("user_id", "day(ts)").collect():
        bits[user] |= np.uint64(1 << day)
    shared, size = np.bitwise_count(bits[:, None] & bits).astype(np.int64), np.bitwise_count(bits).astype(np.int64)
    a, b = np.nonzero(np.triu(2 * shared >= np.minimum(size[:, None], size), 1))
    found = pq.read_table(f"{tmp_path}/pairs").sort_by([("a", "ascending"), ("b", "ascending")])
    assert len(a) > 500_000 and [(found[x].to_numpy() == y).all() for x, y in (("a", a), ("b", b), ("shared", shared[a, b]))] == [True] * 3
    assert sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet")) < 2 * len(a)


def test_sets_in_several_ranges_of_keys_by_hand(spark, monkeypatch):
    rows = [(f"k{k}" if k % 9 else None, d) for k in range(70) for d in range(150) if (k * 7 + d * d) % 11 < k % 13] + [("x", None), ("k5", None), ("k7", 3), ("k7", 3)]
    sets = spark.createDataFrame(rows, "k string, m long")
    want = shared_by_hand(rows)
    monkeypatch.setattr(matching, "BLOCK", 6)
    monkeypatch.setattr(matching, "WIDE", 3)
    assert sorted(tuple(r) for r in matching.shared_members(sets, "k", "m").collect()) == want
    mostly = [x for x in want if x[2] >= 0.6 * min(x[3:])]
    assert 0 < len(mostly) < len(want)
    for bits in (1024, 0):
        monkeypatch.setattr(matching, "MOST_BITS", bits)
        assert sorted(tuple(r) for r in matching.shared_members(sets, "k", "m", 0.6).select("a", "b", "shared", "na", "nb").collect()) == mostly
        assert sorted(tuple(r) for r in matching.shared_members(sets, "k", "m", 0.6, sizes=False).collect()) == [x[:3] for x in mostly]


def test_sets_of_rare_members_meet_by_them(spark):
    rows = [(k, k // 2 + 100 * j) for k in range(60) for j in range(3)] + [(1, None), (None, 2)]
    found = matching.shared_members(spark.createDataFrame(rows, "k long, m long"), "k", "m").select("a", "b", "shared", "na", "nb")
    assert sorted(tuple(r) for r in found.collect()) == shared_by_hand(rows)
    assert "bit_count" not in plan(found)
    empty = spark.createDataFrame([], "k long, m long")
    assert matching.shared_members(empty, "k", "m").collect() == []


def test_repeats_of_a_batch_by_hand_in_small_and_in_crowded_batches(spark, monkeypatch):
    day = lambda d: dt.date(2026, 1, 1) + dt.timedelta(d)
    types = ["festival", "party", "class", None, "congress", "social"]
    rows = [(k % 3 if k % 17 else None, k // 2 if k % 19 else None, k if k % 23 else None, types[k % 6], [day((k * 37) % 120 - 60 + d) for d in range(k % 5)] + [None] * (k % 7 == 0)) for k in range(160)]
    rows += [(0, 500, 900, "class", None), (0, 501, 901, "class", [day(0), day(200)]), (0, 502, 902, "class", [day(200)])]
    known = {r[2] for r in rows if r[2] and r[2] % 4 == 0}
    kind = lambda r: 1 if r[3] in ("congress", "festival") else 2 if r[3] in ("party", "social") and len(r[4] or ()) <= 1 else 0
    meets = lambda a, b: None not in (a[0], a[1], b[1]) and a[0] == b[0] and a[1] < b[1] and kind(a) + kind(b) != 3 and {*(a[4] or ())} & {*(b[4] or ())} - {None}
    want = {(b[0], b[1], b[2]) for a in rows for b in rows if b[2] not in known and meets(a, b)}
    readings = spark.createDataFrame(rows, "batch long, pos long, id long, event_type string, days array<date>")
    matched = spark.createDataFrame([(k,) for k in known] + [(None,)], "id long")
    for crowded in (100_000, 50, 1):
        monkeypatch.setattr(reconcile, "CROWDED", crowded)
        found = reconcile.repeats_earlier(readings, matched)
        assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want)) and len(want) > 20


def test_days_of_readings_are_not_sent_to_every_executor(spark):
    readings = spark.range(100).selectExpr("id % 5 as batch", "id as pos", "id", "'class' as event_type", "sequence(date'2026-01-01', date'2026-03-01') as days")
    found = plan(reconcile.repeats_earlier(readings, readings.select("id").where("id < 3")))
    assert not [x for x in found.splitlines() if "BroadcastHashJoin" in x and "day#" in x]


def test_twins_by_hand_with_few_words_and_with_many(spark, monkeypatch):
    rows = [(k % 3 if k % 11 else None, k if k % 13 else None, f"w{k % 4} w{k % 7} w{k % 4}" if k % 5 else None) for k in range(60)] + [(0, 6, "w2 w6"), (1, 1, "w1"), (9, 99, "alone"), (9, 99, "alone")]
    found = {}
    for a in rows:
        for b in rows:
            if None not in (*a, *b) and a[0] == b[0] and a[1] != b[1] and {*a[2].split()} & {*b[2].split()}:
                found[a[1]] = min(found.get(a[1], b[1]), b[1])
    df = spark.createDataFrame(rows, "block long, k long, said string")
    for few in (100_000, 0):
        monkeypatch.setattr(matching, "FEW", few)
        assert dict(tuple(r) for r in matching.first_twin(df, ["block"], "k", F.split("said", " ")).collect()) == found


def test_twins_send_the_firsts_and_never_the_rows(spark):
    df = spark.range(200).selectExpr("id % 3 as block", "id as k", "concat('w', id % 7, ' w', id % 5) as said")
    found = plan(matching.first_twin(df, ["block"], "k", F.split("said", " ")))
    assert found.count("BuildRight") == 2 and "BuildLeft" not in found


def test_members_that_no_item_has_go_before_any_shuffle(spark, monkeypatch):
    items = spark.createDataFrame([(1, 5), (1, 6), (1, 6), (2, 7), (3, None), (4, 99)], "item long, m long")
    answers = spark.createDataFrame([(8, 5), (8, 5), (9, 5), (9, 6), (7, 6), (7, 5), (3, 7), (4, 8), (5, None)], "answer long, m long")
    for most in (1_000_000, 0):
        monkeypatch.setattr(matching, "MOST_SENT", most)
        found = matching.best_overlap(items, answers, "item", "answer", "m")
        assert sorted(tuple(r) for r in found.collect()) == [(1, 7, 2), (2, 3, 1)]
        assert ("LeftSemi" in plan(found)) == (most > 0)


def test_equal_texts_are_read_once_and_give_what_each_alone_gives(spark, monkeypatch):
    said = ["Desde las 7:30 pm", None, "", "Baile\n12 de marzo", "primero de mayo a mediodía", "mar 5", "del 3 al 5 de junio, ① de julio", "sin fecha", "5, 6 y 7 de abril 8 p. m. a 2 am"]
    rows = spark.createDataFrame([(i, said[i % len(said)]) for i in range(200)], "i long, x string").repartition(1)
    alone = [mentions.scan(x or "") for x in said]
    for r in rows.select("i", mentions.mentions("x").alias("m")).collect():
        assert r["m"].asDict(True) == alone[r["i"] % len(said)]
    reads = []
    monkeypatch.setattr(mentions, "known_scan", lambda x: reads.append(x) or mentions.scan(x))
    import pyarrow as pa

    out = mentions.mentions.func(pa.array([said[i % len(said)] for i in range(900)]))
    assert len(out) == 900 and len(reads) == len(said)


def test_readers_start_at_every_place_they_can():
    def all_places(line, reader):
        out, i = [], 0
        while i < len(line):
            hit = reader(line, i)
            out += [(i, hit[1], hit[0])] if hit else []
            i = max(hit[1], i + 1) if hit else i + 1
        return out

    words = "12 de marzo primero mayo. del 3 al 5 y & 7/8 , 2026 medianoche 8:30 pm a m las 10h mar hasta -".split()
    for k in range(400):
        line = mentions.Line(" ".join(words[(k * k + 3 * j * (k % 7 + 1) + j // 3) % len(words)] for j in range(12)))
        for reader in (mentions.read_date, mentions.read_range, mentions.read_list, mentions.read_time, mentions.read_span):
            assert mentions._found(line, reader) == all_places(line, reader)


def test_bare_words_are_learned_without_a_pattern(monkeypatch):
    import public_tokenizers
    import pyarrow as pa

    from heraldo.llm import token_store

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        encoder = token_store.TextEncoder(file.read())
    plain, asked = token_store._PLAIN, []
    monkeypatch.setattr(token_store, "_PLAIN", lambda c: asked.append(c) or plain(c))
    texts = ["hello world, hello", "é ª x1 !! 12", "", "Ana-Lía dijo: ok."]
    found = [x.tolist() for x in encoder.encode(pa.array(texts))]
    assert found == [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, token_store.END_ID] for t in texts]
    assert "hello" not in asked and "world," in asked
