"""Resampling against counts by plain Python, for several lengths of n-grams, and awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from heraldo.llm import resample


def plain_features(text, n, buckets):
    ws = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}).encode())
    return len(ws), [zlib.crc32(b" ".join(ws[i : i + k])) % buckets for i in range(len(ws)) for k in range(1, n + 1) if i + k <= len(ws)]


def plain(rows, target, n, buckets, percent, least, seed):
    docs = [(d, *plain_features(t, n, buckets)) for d, t in rows]
    s, t = Counter(b for _, _, f in docs for b in f), Counter(b for x in target for b in plain_features(x, n, buckets)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for d, words, f in docs:
        first = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f)) // len(f) if f else 0
        out.append([d, words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((first + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[3], r[2]))
    for place, r in enumerate(fit[: percent * len(fit) // 100], 1):
        r[5] = place
    return sorted((tuple([r[0], *r[2:]]) for r in out), key=str)


def found(spark, rows, target, n, buckets, percent, least, seed):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS weight", "1 AS key", "2 AS rank", "3 AS buckets")
    out = resample.resampled(docs, spark.createDataFrame([(x,) for x in target], "text string"), n=n, buckets=buckets, percent=percent, least_words=least, seed=seed)
    return sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in out.collect()), key=str)


@pytest.mark.parametrize("n, buckets", [(1, 10_000), (2, 97), (3, 100_000)])
def test_against_plain_counts(spark, n, buckets):
    words = "red green blue Été über 42 x_y a-b".split()
    rows = [(i, " ".join(words[(i * j) % 8] for j in range(1, 3 + i % 40))) for i in range(120)]
    args = (n, buckets, 30, 10, 7)
    assert found(spark, rows, ["blue über blue", None, "green 42"], *args) == plain(rows, ["blue über blue", None, "green 42"], *args)


def test_null_empty_repeated_and_long_texts(spark):
    rows = [(None, None), (None, "a b c"), (1, ""), (1, "a b c"), (1, "a b c"), (1, "a b c"), (2, " ,.; \n"), (3, "word " * 400_000), (4, " a\u0000b")]
    args = (2, 1000, 50, 2, 1)
    assert found(spark, rows, [], *args) == plain(rows, [], *args)
    assert found(spark, [], ["x"], *args) == []


def test_the_ring_emits_every_run_once():
    ws = [b"a", b"bb", b"c", b"a"]
    for n in (1, 2, 3, 9):
        expected = [zlib.crc32(b" ".join(ws[i : i + k])) % 1009 for i in range(4) for k in range(1, n + 1) if i + k <= 4]
        assert sorted(resample.feature_hashes(ws, n, 1009)) == sorted(expected)
