"""Rows of one doc_id, of none, and equal ones are judged by their own texts, against brute force."""

import random

import corpus_pipeline
from heraldo.llm import line_dedup, near_dedup

from .test_operators import lower, words


def linked(a, b, size, percent):
    sets = []
    for text in (a, b):
        ws = words(lower(text or ""))
        sets.append({tuple(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))} if ws else set())
    both = len(sets[0] & sets[1])
    return both > 0 and 100 * both >= percent * len(sets[0] | sets[1])


def groups(rows, size, percent):
    """Of each row's number the numbers of its group."""
    of = {i: {i} for i in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            if of[i] is not of[j] and linked(rows[i][1], rows[j][1], size, percent):
                of[i] |= of[j]
                for k in of[i]:
                    of[k] = of[i]
    return of


def made(seed, n=60):
    rng = random.Random(seed)
    base = [" ".join(rng.choice("red blue green one two three four five six seven".split()) for _ in range(40)) for _ in range(8)]
    rows = [(rng.choice([None, 1, 2, 3, 4, 5, *range(10, 60)]), rng.choice([None, "", "three words here", *base, *(b.replace("red", "rojo", 1) for b in base)])) for _ in range(n)]
    return rows + [(None, base[0]), (None, base[0]), (7, base[1]), (7, base[1]), (7, base[2]), (8, "all alone in this table of rows")]


def test_near_duplicates_of_null_and_repeated_ids(spark):
    rows = made(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS doc").coalesce(1)
    found = near_dedup.near_duplicates(near_dedup.numbered(docs), shingle=4, percent=80).orderBy("row").collect()
    of = groups(rows, 4, 80)
    least = lambda i: min((rows[k][0] for k in of[i] if rows[k][0] is not None), default=None)
    assert [(r["doc_id"], r["component_id"]) for r in found] == [(rows[i][0], least(i)) for i in range(len(rows))]
    first = {min(of[i], key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k)) for i in of}
    assert [i for i, r in enumerate(found) if r["kept"]] == sorted(first)
    stay = near_dedup.filter_documents(docs, shingle=4, percent=80)
    assert stay.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in stay.collect()), key=str) == sorted((rows[i] for i in first), key=str)


def plain_lines(spark, rows, near=5):
    """Of each row its text without lines that an earlier one equals or nearly equals; rows by doc_id, hash and number."""
    hashed = [r[0] for r in spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "i int, t string").orderBy("i").selectExpr("xxhash64(t)").collect()]
    alike = lambda a, b: a == b or (len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1) or any(len(x) == len(y) + 1 and any(x[:k] + x[k + 1 :] == y for k in range(len(x))) for x, y in ((a, b), (b, a)))
    seen, out = [], {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, hashed[i], i)):
        kept = []
        for line in (rows[i][1] or "").split("\n"):
            ws = line.lower().split()
            if not ws or not any(ws == x or (min(len(ws), len(x)) >= near and alike(ws, x)) for x in seen):
                kept.append(line)
            if ws:
                seen.append(ws)
        out[i] = rows[i][1] and "\n".join(kept)
    return sorted(((rows[i][0], out[i]) for i in out), key=str)


def test_lines_of_null_and_repeated_ids(spark):
    rows = [(None, "x\nAccept all cookies"), (None, "Accept all cookies\ny"), (3, "same old line of six words\nz"), (3, "same old line of six words"), (3, "same old line of six words"), (2, "z\nsame old line of six wards"), (None, None), (None, None), (1, "\n"), (2, "y"), (7, ""), (7, "")]
    rows += made(2)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS line", "3 AS again")
    found = sorted(((r["doc"]["doc_id"], r["doc"]["text"]) for r in line_dedup.deduplicated(docs).collect()), key=str)
    assert found == plain_lines(spark, rows)


def test_pipeline_stages_keep_rows_without_ids(spark):
    text = lambda k: " ".join(f"word{k}x{i}" for i in range(70))
    rows = [(None, text(1)), (None, text(2)), (None, text(1)), (4, text(3)), (4, text(4)), (4, text(3)), (5, None), (6, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    stay = corpus_pipeline.near_dedup_documents(spark, docs, "")
    assert stay.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in stay.collect()), key=str) == sorted([(None, text(1)), (None, text(2)), (4, text(3)), (4, text(4)), (5, None), (6, "")], key=str)
    lines = corpus_pipeline.dedup_lines(spark, docs, "").collect()
    assert sorted(((r["doc_id"], r["text"]) for r in lines), key=str) == sorted([(None, text(1)), (None, text(2)), (4, text(3)), (4, text(4)), (5, None), (6, "")], key=str)
