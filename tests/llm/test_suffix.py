"""Removal of repeated byte strings against a dictionary of all windows, with split anchors, patterns and awkward rows."""

import hashlib
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from heraldo.llm import suffix_dedup

from ..conftest import SMALL


def plain(rows, length):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for d, t in texts:
        gone = np.zeros(len(t) + 2, np.int8)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i + 1 : i + length + 1] = 1
        edges = np.flatnonzero(np.diff(gone))
        out.append((str(d), len(t), [tuple(x) for x in edges.reshape(-1, 2).tolist()], bytes(b for b, g in zip(t, gone[1:]) if not g)))
    return sorted(out, key=repr)


def found(spark, rows, length, seed):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS key", "'x' AS lo")
    out = suffix_dedup.repeated_spans(docs, length=length, seed=seed).collect()
    return sorted(((str(r["doc_id"]), r["n_bytes"], [(s["begin"], s["end"]) for s in r["removed"]], bytes(r["kept"])) for r in out), key=repr)


def test_arrays_and_common_prefixes():
    rng = np.random.default_rng(3)
    for _ in range(80):
        data = rng.integers(97, 97 + rng.integers(1, 4), rng.integers(1, 200)).astype(np.uint8)
        text, order = data.tobytes(), suffix_dedup.suffix_array(data)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        alike = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        expected = [0, *(min(30, alike(text[i:], text[j:])) for i, j in zip(order[:-1], order[1:]))]
        assert suffix_dedup.common_prefixes(data, order, 30).tolist() == expected


def made(seed):
    rng = np.random.default_rng(seed)
    bits = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(5, 60))) for _ in range(40)]
    rows = [(i, "".join(bits[k] for k in rng.integers(0, 40, rng.integers(0, 8))) + "é" * int(rng.integers(0, 3))) for i in range(60)]
    passage = bits[0] + bits[1] + bits[2] + "#" * 25
    return rows + [(100 + i, bits[i % 40][:7] + str(i) * 5 + passage + str(i) * 6) for i in range(40)]


@pytest.mark.parametrize("part, shard", [(1000, 1 << 20), (3, 1 << 12), (1, 1 << 10)])
def test_against_all_windows(spark, monkeypatch, part, shard):
    monkeypatch.setattr(suffix_dedup, "PART", part)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    monkeypatch.setattr(suffix_dedup, "RANGE_BYTES", 1 << 10)
    rows = made(part)
    assert found(spark, rows, 40, 13) == plain(rows, 40)


def test_patterns_nulls_copies_and_short_texts(spark):
    text = "The quick brown fox jumps over the lazy dog, twice a day. "
    rows = [(None, None), (None, text), (None, text), (1, ""), (1, text[:39]), (1, text[:39]), (2, "a" * 500), (3, "ab" * 40), (4, text[:30] + "\x00" * 90), (5, "x" + text[1:41] + "y")]
    assert found(spark, rows, 40, 13) == plain(rows, 40)
    assert found(spark, [], 40, 13) == []


def test_texts_longer_than_a_block(spark):
    rng = np.random.default_rng(5)
    long = "".join(chr(97 + c) for c in rng.integers(0, 4, 1 << 20))
    rows = [(1, long + "zz" + long[500_000:500_700]), (2, "q" * 300 + long[(1 << 20) - 900 : 1 << 20]), (3, "r" * 1_100_000)]
    (a, b, c) = found(spark, rows, 400, 128)
    n = 1 << 20
    assert a[2] == [(500_000, 500_700), (n - 900, n), (n + 2, n + 702)]
    assert b[2] == [(300, 1200)] and c[2] == [(0, 1_100_000)]


def test_given_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    out = suffix_dedup.repeated_spans(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    assert sorted(((str(r["doc_id"]), r["n_bytes"], [tuple(s) for s in r["removed"]], bytes(r["kept"])) for r in out), key=repr) == plain(rows, 400)


def test_query_on_passages_of_over_50_words(spark, tmp_path):
    rng = np.random.default_rng(9)
    words = lambda n: " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 5)) for _ in range(n))
    fits, short = words(80)[:400], words(80)[:399]
    assert len(fits.split()) > 50 and len(short.split()) > 50
    rows = [(i, words(150)) for i in range(6)]
    rows += [(10, f"{words(90)}({fits}){words(90)}"), (11, fits + "+" + words(90)), (12, words(20) + "#" + fits)]
    rows += [(20, f"{words(90)}({short}){words(90)}"), (21, short + "+" + words(90)), (22, words(20) + "#" + short)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.op13_suffix_dedup(spark, str(tmp_path)).collect()}
    assert {d for d, x in out.items() if x[1]} == {10, 11, 12}
    for d, text in rows:
        kept = text.replace(fits, "").encode()
        assert out[d] == (len(text), len(text) - len(kept), int(d in (10, 11, 12)), hashlib.sha256(kept).hexdigest())


def test_zero_bytes_at_the_end(spark):
    for text in (b"ab\0\0\0", b"\0" * 20, b"\0a\0", b"b\0\0a\0\0"):
        order = suffix_dedup.suffix_array(np.frombuffer(text, np.uint8))
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    shared = "".join(np.random.default_rng(1).choice(list("abcdefgh "), 36)) + "\0" * 4
    rows = [(k, "XYZ"[k] * (k + 1) + shared) for k in range(3)]
    assert found(spark, rows, 40, 13) == plain(rows, 40)


@pytest.mark.parametrize("part, piece", [(1000, 1), (1000, 1 << 11), (3, 1 << 9)])
def test_shards_in_pieces(spark, monkeypatch, part, piece):
    monkeypatch.setattr(suffix_dedup, "PART", part)
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", piece)
    monkeypatch.setattr(suffix_dedup, "RANGE_BYTES", 1 << 10)
    rows = made(7)
    assert found(spark, rows, 40, 13) == plain(rows, 40)


def peak_mb(work):
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_memory_of_a_full_shard_and_of_a_scan():
    rng = np.random.default_rng(4)
    bits = rng.integers(97, 123, (1500, 672)).astype(np.uint8)
    texts = [(k % 1500, bytes(bits[k % 1500]) if k < 1500 else bytes(np.roll(bits[k % 1500], 100))) for k in range(6000)]
    no = np.arange(len(texts))
    columns = {"key": [k for k, _ in texts], "r1": no, "r2": no, "m": np.full(len(no), 273), "c": np.ones(len(no), int), "spread": np.ones(len(no), int), "shard": np.zeros(len(no), int)}
    group = pa.table({**{x: pa.array(column, pa.int64()) for x, column in columns.items()}, "data": [t for _, t in texts]})
    out, most = peak_mb(lambda: suffix_dedup._shard(400, 1)(group))
    assert most < 130  # 4 MB of records
    runs = dict(zip(out.column("r1").to_pylist(), out.column("spans").to_pylist()))
    assert len(runs) == 6000 and sorted(out.column("no").to_pylist()) == no.tolist()
    assert all(np.frombuffer(runs[k], "<i4").tolist() == ([0, 173] if k < 1500 else [0, 273]) for k in range(6000))

    batch = pa.record_batch({"row": list(range(3)), "text": ["".join(map(chr, rng.integers(97, 123, 900_000))) for _ in range(3)]})
    _, most = peak_mb(lambda: [x.num_rows for x in suffix_dedup._scan(400, 128)([batch])])
    assert most < 90
