"""Language-model scoring by context-tree weighting.

Texts are bytes (A-Z lowered) with an end byte. A byte is eight binary decisions, each in its own context tree over the
preceding DEPTH bytes; a node holds how often its decision went either way in training. Its Krichevsky-Trofimov
probability is mixed half and half with the product of its children's weighted probabilities, at all depths, and the
frozen counts then predict by the posterior of each mixture. Nodes that training never reached predict 1/2. Code length
per byte follows from the score.

Everything is counted over all training texts, and nothing of the model is broadcast:

* Texts become stored batches of about BATCH_BYTES. A batch's distinct (DEPTH + 1)-grams, sorted and delta-coded, are cut
  into buckets by their SPLIT nearest context bytes, so that each subtree below SPLIT lies in one bucket. Token hashes are
  dealt likewise. A gram or token that is in every text is one number per batch.
* A bucket merges its batches' grams and weighs its subtrees from the deepest level up. The levels above SPLIT are grouped
  sums over what the subtrees' roots say, and joins on the way down.
* With what the levels above give each root, a bucket finds the probability of each of its grams' bytes, and sends every
  batch the values of its own grams, in order. The batch sums them by text.

Buckets are sized by the input's bytes. A bucket's least part is one context of SPLIT bytes, whose distinct grams are
pre-aggregated by batch; very long texts are a batch of their own, which one task holds at about forty times its size.

Beside it: the add-one unigram score over white-space tokens with an end token per text.

Defined cases: null is the empty text, which is its end alone; a null doc_id counts as the empty id, so it trains;
without training texts all decisions are 1/2; rows are scored one by one and repeated rows train repeatedly; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import persisted, reclaimed, slices, table
from .kernels import NON_SPACE, U64, lowered, mix, utf8, words_of

DEPTH, SPLIT = 7, 3  # DEPTH context bytes and the byte itself fill a 64-bit key
BATCH_BYTES, PIECE_BYTES, BUCKET_BYTES = 8 << 20, 2 << 20, 4 << 20
HELD_OUT, FOLDS = 2, 7
END_BYTE = 255
END_TOKEN = np.array([0x5EED0F7E47], U64)
TOKEN, GRAM = 0, 1
LN2 = math.log(2)
SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long"
#: Stored batches, and what buckets send back to them.
PARTS = "batch long, kind int, bucket int, doc_ids array<long>, sizes array<long>, blob binary"


def held_out(doc_ids: list) -> np.ndarray:
    return np.array([zlib.crc32(("" if i is None else str(i)).encode()) % FOLDS == HELD_OUT for i in doc_ids], bool)


def grams_of(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's (depth + 1)-grams, one per byte and one for its end, and the bounds of each text's.

    A key holds the nearest byte of context on top, the farthest at last and then the byte itself.
    """
    lens = np.diff(offsets)
    # every text stands between `depth` zeros and its end byte
    begin = offsets[:-1] + np.arange(len(lens)) * (depth + 1)
    size = len(data) + len(lens) * (depth + 1)
    of_text = np.ones(size, bool)
    of_text[begin[:, None] + np.arange(depth)] = False
    whole = of_text.copy()
    of_text[begin + depth + lens] = False
    padded = np.zeros(size, np.uint8)
    padded[of_text] = lowered(data)
    padded[begin + depth + lens] = END_BYTE
    keys = padded[depth:].astype(U64)
    for j in range(1, depth + 1):
        keys |= padded[depth - j : size - j].astype(U64) << U64(8 * (depth + 1 - j))
    return keys[whole[depth:]], offsets + np.arange(len(offsets))


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each text's token hashes with an end token, and their bounds."""
    words = words_of(column, NON_SPACE, lower=True)
    return np.insert(words.hashes, words.first[1:], END_TOKEN[0]), words.first + np.arange(len(words.first))


def _features(column: pa.Array, depth: int):
    """(kind, keys, bounds) of a batch's texts."""
    yield TOKEN, *tokens_of(column)
    yield GRAM, *grams_of(*utf8(column), depth)


def _bucket_of(keys: np.ndarray, kind: int, depth: int, n: int) -> np.ndarray:
    near = keys >> U64(8 * (depth - min(SPLIT, depth) + 1)) if kind == GRAM else keys
    return (mix(near) % U64(n)).astype(np.uint16 if n <= 1 << 16 else np.int64)


def _fresh(keys: np.ndarray) -> np.ndarray:
    """Where another key begins."""
    return np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)  # without counts np.unique hashes, which is slower here
    return keys[_fresh(keys)]


def _squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays compressed, the first bytes of all numbers before the second ones and so on."""
    planes = (np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes() for x in arrays)
    return zstandard.compress(b"".join(planes), 1)


def _taken(raw: bytes, dtype: type, n: int, at: int = 0) -> np.ndarray:
    """n numbers whose planes begin at a byte of what _squeezed compressed."""
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(dtype).reshape(-1)


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as rows of PARTS, one a batch."""
    numbers = count(TaskContext.get().partitionId() << 24)
    schema = pa.schema([("batch", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("blob", pa.binary())])
    for batch in batches:
        for part in slices(batch, limit=BATCH_BYTES):
            data, offsets = utf8(part.column("text"))
            row = [[next(numbers)], [None], [None], [part.column("doc_id").to_pylist()], [np.diff(offsets)], [zstandard.compress(data.tobytes(), 6)]]
            yield pa.record_batch([pa.array(x, f.type) for x, f in zip(row, schema)], schema=schema)


def _pieces(sizes: list[int], blob: bytes) -> Iterator[pa.Array]:
    """A stored batch's texts, in order, in pieces that arrays of eight times their size stay small for."""
    offsets = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))]).astype(np.int64)
    texts = pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(zstandard.decompress(blob))])
    for part in slices(pa.record_batch([texts], names=["text"]), limit=PIECE_BYTES):
        yield part.column("text")


def _dealt(depth: int, n_buckets: int):
    """For each stored batch its distinct keys, by kind and bucket, with how many of each are in training."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for row in rows.to_pylist():
                train, at = ~held_out(row["doc_ids"]), 0
                trained, others = {TOKEN: [], GRAM: []}, {TOKEN: [], GRAM: []}
                for piece in _pieces(row["sizes"], row["blob"]):
                    for kind, keys, bounds in _features(piece, depth):
                        used = np.repeat(train[at : at + len(piece)], np.diff(bounds))
                        trained[kind].append(np.unique(keys[used], return_counts=True))
                        others[kind].append(_distinct(keys[~used]))
                    at += len(piece)
                for kind in (TOKEN, GRAM):
                    every = _distinct(np.concatenate([*others[kind], *(k for k, _ in trained[kind])]))
                    n = np.zeros(len(every), np.uint32)
                    for keys, times in trained[kind]:
                        n[np.searchsorted(every, keys)] += times.astype(np.uint32)
                    bucket = _bucket_of(every, kind, depth, n_buckets)
                    order = np.argsort(bucket, kind="stable")
                    every, n, bucket = every[order], n[order], bucket[order]
                    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
                    blobs = [_squeezed(np.diff(every[a:b], prepend=U64(0)), n[a:b]) for a, b in zip(edges[:-1], edges[1:])]
                    m = len(blobs)
                    yield pa.record_batch(
                        [pa.array(np.full(m, kind, np.int32)), pa.array(bucket[edges[:-1]].astype(np.int32)), pa.array(np.full(m, row["batch"])), pa.array(np.diff(edges)), pa.array(blobs, pa.binary())],
                        names=["kind", "bucket", "batch", "n", "blob"],
                    )

    return run


# ---- counting and weighing within a bucket

_TABLE = 1 << 16
_HALF = np.concatenate([[0.0], np.cumsum(np.log(np.arange(_TABLE) + 0.5))])
_FACT = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, _TABLE + 1)))])


def _stirling(x: np.ndarray) -> np.ndarray:
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x)


def _log_of(n: np.ndarray, known: np.ndarray, ahead: float, off: float) -> np.ndarray:
    out = known[np.minimum(n, _TABLE)]
    far = np.flatnonzero(n > _TABLE)
    out[far] = _stirling(n[far] + ahead) - off
    return out


def kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    half = 0.5 * math.log(math.pi)
    return _log_of(n0, _HALF, 0.5, half) + _log_of(n1, _HALF, 0.5, half) - _log_of(n0 + n1, _FACT, 1.0, 0.0)


def _levels(keys: np.ndarray, n: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """From the deepest level up to SPLIT: the distinct (context, byte) rows, their counts, and each one's row a level up."""
    out = []
    for _ in range(depth - min(SPLIT, depth)):
        up, above = np.unique((keys >> U64(16)) << U64(8) | (keys & U64(255)), return_inverse=True)
        out.append((keys, n, above))
        keys, n = up, np.bincount(above, n, len(up)).astype(np.int64)
    return [*out, (keys, n, None)]


class Nodes:
    """The nodes of one level for one of a byte's eight decisions: which rows are theirs, counts, weights."""

    def __init__(self, rows: np.ndarray, n: np.ndarray, bit: int):
        prefix = rows >> U64(8 - bit)
        self.first = np.flatnonzero(_fresh(prefix))
        self.of_row = np.repeat(np.arange(len(self.first)), np.diff(np.append(self.first, len(rows))))
        self.n1 = np.add.reduceat(np.where(rows >> U64(7 - bit) & U64(1), n, 0), self.first)
        self.n0 = np.add.reduceat(n, self.first) - self.n1
        self.weighted, self.share = kt(self.n0, self.n1), None

    def over(self, below: Nodes, above: np.ndarray) -> Nodes:
        """With the nodes of the next deeper level, whose rows have the rows `above` here."""
        below.parent = self.of_row[above[below.first]]
        own = self.weighted
        self.weighted = np.logaddexp(own, np.bincount(below.parent, below.weighted, len(own))) - LN2
        self.share = np.exp(own - self.weighted - LN2)
        return self

    @property
    def zero(self) -> np.ndarray:
        return (self.n0 + 0.5) / (self.n0 + self.n1 + 1.0)


def _weighed(levels: list, bit: int) -> list[Nodes]:
    out = [Nodes(*levels[0][:2], bit)]
    for (_, _, above), (rows, n, _) in zip(levels, levels[1:]):
        out.append(Nodes(rows, n, bit).over(out[-1], above))
    return out


def _unsqueezed(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(blob)
    return np.cumsum(_taken(raw, U64, n)), _taken(raw, np.uint32, n, 8 * n)


MERGED = "kind int, bucket int, n_batches int, batches array<long>, sizes array<long>, n_keys long, total long, trained long, blob binary, roots array<struct<ctx:long,node:int,n0:long,n1:long,weighted:double>>"
_ROOT = [("ctx", pa.int64()), ("node", pa.int32()), ("n0", pa.int64()), ("n1", pa.int64()), ("weighted", pa.float64())]


def _merge(depth: int):
    """One bucket: its keys with their counts, where each batch's keys are among them, and the roots of its subtrees."""

    def run(group: pa.Table) -> pa.Table:
        kind, bucket = group.column("kind")[0].as_py(), group.column("bucket")[0].as_py()
        sizes = group.column("n").to_numpy()
        parts = [_unsqueezed(b.as_py(), n) for b, n in zip(group.column("blob"), sizes)]
        keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        n = np.bincount(place, np.concatenate([c for _, c in parts]), len(keys)).astype(np.int64)
        del parts
        ends = np.cumsum(sizes)
        steps = [np.diff(place[a:b], prepend=0).astype(np.uint32) for a, b in zip(ends - sizes, ends)]
        blob = _squeezed(np.diff(keys, prepend=U64(0)), n, *steps)
        roots = [np.zeros(0, np.int64)] * 5
        if kind == GRAM:
            del steps, place
            levels, found = _levels(keys, n, depth), []
            rows = levels[-1][0]
            for bit in range(8):
                top = _weighed(levels, bit)[-1]
                row = rows[top.first]
                found.append(((row >> U64(8)).astype(np.int64), ((row & U64(255)) >> U64(8 - bit)).astype(np.int64) | (1 << bit), top.n0, top.n1, top.weighted))
            roots = [np.concatenate(x) for x in zip(*found)]
        listed = pa.StructArray.from_arrays([pa.array(x, t) for x, (_, t) in zip(roots, _ROOT)], fields=[pa.field(*f) for f in _ROOT])
        row = {"kind": [kind], "bucket": [bucket], "n_batches": [len(sizes)], "batches": [group.column("batch").to_pylist()], "sizes": [sizes], "n_keys": [len(keys)], "total": [int(n.sum())], "trained": [int((n > 0).sum())], "blob": [blob]}
        types = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        arrays = [pa.array(x, t) for x, t in zip(row.values(), types)]
        return pa.table([*arrays, pa.ListArray.from_arrays(pa.array([0, len(listed)], pa.int32()), listed)], names=[*row, "roots"])

    return run


def _values(keys: np.ndarray, n: np.ndarray, depth: int, given: dict[str, np.ndarray]) -> np.ndarray:
    """log10 probability of each gram's byte; given: what the levels above SPLIT say for each root."""
    levels, out = _levels(keys, n, depth), np.zeros(len(keys))
    order = np.lexsort((given["node"], given["ctx"]))
    begins = given["node"][order]
    for bit in range(8):
        own = order[(begins >> bit) == 1]
        got, left = given["got"][own], given["left"][own]
        nodes = _weighed(levels, bit)
        for level, below in zip(nodes[:0:-1], nodes[-2::-1]):
            got, left = got + left * level.share * level.zero, left * (1 - level.share)
            got, left = got[below.parent], left[below.parent]
        zero = got + left * nodes[0].zero
        out += np.where(keys >> U64(7 - bit) & U64(1), np.log10(1 - zero)[nodes[0].of_row], np.log10(zero)[nodes[0].of_row])
    return out


def _sent_back(depth: int):
    """Rows of PARTS: for each batch of a bucket the counts of its tokens, or the values of its grams, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i in range(rows.num_rows):
                row = {c: rows.column(c)[i] for c in rows.schema.names}
                kind, sizes, m = row["kind"].as_py(), row["sizes"].as_py(), row["n_keys"].as_py()
                raw = zstandard.decompress(row["blob"].as_py())
                keys, n = np.cumsum(_taken(raw, U64, m)), _taken(raw, np.int64, m, 8 * m)
                if kind == GRAM:
                    given = row["given"].values
                    values = _values(keys, n, depth, {c: given.field(c).to_numpy() for c in ("ctx", "node", "got", "left")}).astype(np.float32)
                else:
                    values = n.astype(np.float64)
                at, blobs = 16 * m, []
                for size in sizes:
                    blobs.append(_squeezed(values[np.cumsum(_taken(raw, np.uint32, size, at), dtype=np.int64)]))
                    at += 4 * size
                k = len(sizes)
                yield pa.record_batch([pa.array(row["batches"].as_py(), pa.int64()), pa.array(np.full(k, kind, np.int32)), pa.array(np.full(k, row["bucket"].as_py(), np.int32)), pa.nulls(k, pa.list_(pa.int64())), pa.nulls(k, pa.list_(pa.int64())), pa.array(blobs, pa.binary())], names=["batch", "kind", "bucket", "doc_ids", "sizes", "blob"])

    return run


# ---- the levels above SPLIT


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1/2, by Stirling's series at x + 8."""
    y = x + 8
    shift = sum((F.ln(x + i) for i in range(1, 8)), F.ln(x))
    return (y - 0.5) * F.ln(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y) - shift


def _log_add(a: Column, b: Column) -> Column:
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))


def given_from_above(roots: DataFrame, split: int) -> DataFrame:
    """(bucket, ctx, node, got, left) for every root (bucket, ctx, node, n0, n1, weighted).

    The probability of a zero there is got + left * (what the root's own subtree says).
    """
    estimate = log_gamma(F.col("n0") + 0.5) + log_gamma(F.col("n1") + 0.5) - F.lit(math.log(math.pi)) - log_gamma(F.col("n0") + F.col("n1") + 1.0)
    up = F.shiftright("ctx", 8)
    levels, here = {}, roots
    for d in range(split - 1, -1, -1):
        here = here.groupBy(up.alias("ctx"), "node").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("weighted").alias("below")).withColumn("own", estimate)
        here = here.withColumn("weighted", _log_add(F.col("own"), F.col("below")) - LN2)
        here = here.select("ctx", "node", "n0", "n1", "weighted", F.exp(F.col("own") - F.col("weighted") - LN2).alias("share"))
        levels[d] = here = persisted(here, f"tree-{d}")
    zero = (F.col("n0") + 0.5) / (F.col("n0") + F.col("n1") + 1.0)
    down = levels[0].select("ctx", "node", (F.col("share") * zero).alias("got"), (1 - F.col("share")).alias("left"))
    above = lambda: down.select(F.col("ctx").alias("up"), F.col("node").alias("at"), F.col("got").alias("g"), F.col("left").alias("l"))
    for d in range(1, split):
        joined = levels[d].join(above(), (up == F.col("up")) & (F.col("node") == F.col("at")))
        down = joined.select("ctx", "node", (F.col("g") + F.col("l") * F.col("share") * zero).alias("got"), (F.col("l") * (1 - F.col("share"))).alias("left"))
    return roots.select("bucket", "ctx", "node").join(above(), (up == F.col("up")) & (F.col("node") == F.col("at"))).select("bucket", "ctx", "node", F.col("g").alias("got"), F.col("l").alias("left"))


# ---- scores


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, each key's place among them, and where in `keys` that one stood."""
    # sorted by hash, with the place in the low bits: numbers sort faster than places do
    low = U64(max(1, len(keys).bit_length()))
    order = mix(keys)
    order >>= low
    order <<= low
    order |= np.arange(len(keys), dtype=U64)
    order.sort()
    order &= (U64(1) << low) - U64(1)
    order = order.view(np.int64)
    by_hash = keys[order]
    fresh = _fresh(by_hash)  # keys whose hashes agree take turns, so that one may have several runs
    distinct, run = np.unique(by_hash[fresh], return_inverse=True)
    return distinct, run[np.cumsum(fresh) - 1], order


def _score(depth: int, n_buckets: int, n: int, v: int):
    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        (text,) = (r for r in rows if r["kind"] is None)
        parts = sorted((r["kind"], r["bucket"], i) for i, r in enumerate(rows) if r["kind"] is not None)
        every = {TOKEN: [], GRAM: []}
        for piece in _pieces(text["sizes"], text["blob"]):
            for kind, keys, _ in _features(piece, depth):
                every[kind].append(_distinct(keys))
        found = {}
        for kind, dtype in ((TOKEN, np.dtype(np.float64)), (GRAM, np.dtype(np.float32))):
            every[kind] = _distinct(np.concatenate(every[kind]))
            raws = (zstandard.decompress(rows[i]["blob"]) for k, _, i in parts if k == kind)
            found[kind] = np.empty(len(every[kind]), dtype)
            found[kind][np.argsort(_bucket_of(every[kind], kind, depth, n_buckets), kind="stable")] = np.concatenate([_taken(raw, dtype, len(raw) // dtype.itemsize) for raw in raws])
        del rows, group
        sums = {"n_tokens": [], "known": [], "base": [], "score": [], "n_bytes": []}
        for piece in _pieces(text["sizes"], text["blob"]):
            for kind, keys, bounds in _features(piece, depth):
                distinct, place, order = _runs(keys)
                got = np.empty(len(keys))
                got[order] = found[kind][np.searchsorted(every[kind], distinct)][place]
                add = lambda x, bounds=bounds: np.add.reduceat(x, bounds[:-1])  # noqa: E731  every text has its end at least
                if kind == GRAM:
                    sums["score"].append(add(got))
                    sums["n_bytes"].append(np.diff(bounds) - 1)
                else:
                    sums["n_tokens"].append(np.diff(bounds))
                    sums["known"].append(add((got > 0).astype(np.int64)))
                    sums["base"].append(add(np.log10((got + 1) / (n + v + 1))))
        n_tokens, known, base, score, n_bytes = (np.concatenate(x) for x in sums.values())
        ids = text["doc_ids"]
        arrays = [pa.array(ids, pa.int64()), held_out(ids), n_tokens, known, np.full(len(ids), n), base, score, n_bytes]
        return pa.table([a if isinstance(a, pa.Array) else pa.array(a) for a in arrays], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return run


def score(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """SCHEMA for every row of (doc_id, text): trained on the folds that aren't held out, scored on all."""
    spark = docs.sparkSession
    texts = persisted(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_stored, PARTS), "texts")
    size = texts.select(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("s")).agg(F.sum("s")).first()[0] or 0
    n_buckets = max(spark.sparkContext.defaultParallelism, -(-size // BUCKET_BYTES))
    dealt = texts.mapInArrow(_dealt(depth, n_buckets), "kind int, bucket int, batch long, n long, blob binary")
    merged = persisted(dealt.groupBy("kind", "bucket").applyInArrow(_merge(depth), MERGED), "merged")
    del dealt
    reclaimed(spark)
    known = merged.where(f"kind = {TOKEN}").agg(F.sum("total").alias("n"), F.sum("trained").alias("v")).first()
    roots = merged.where(f"kind = {GRAM}").select("bucket", F.inline("roots"))
    given = given_from_above(roots, min(SPLIT, depth)).groupBy("bucket").agg(F.collect_list(F.struct("ctx", "node", "got", "left")).alias("given")).select(F.lit(GRAM).alias("kind"), "bucket", "given")
    values = merged.drop("roots").join(given, ["kind", "bucket"], "left").mapInArrow(_sent_back(depth), PARTS)
    return texts.unionByName(values).groupBy("batch").applyInArrow(_score(depth, n_buckets, known["n"] or 0, known["v"] or 0), SCHEMA)


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents")).drop("n_bytes")
