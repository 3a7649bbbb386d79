"""Removal of long byte strings that occur more than once, by suffix arrays over shards of the corpus.

Where two strings of `length` bytes are equal, so are their least SEED-byte hashes and these ones' places in them. So each
window of `length` bytes belongs to an anchor, the place of its least hash; consecutive windows of one anchor are a record
(up to length - SEED + 1 windows), and only records with the same anchor hash can hold equal windows. Records with the same
bytes fall together first, and those whose anchor hash occurs once are out; an anchor hash with one record that occurs
several times is settled. The texts of all other distinct records are dealt to shards by their anchor hash, and a shard is
worked on in pieces of whole anchor hashes, so that memory follows a piece, however unevenly the shards are filled. Each piece
is one suffix array (Larsson-Sadakane: ranks doubled, unsorted groups only) with Kasai's common prefixes, in which windows
with a common prefix of `length` are equal. An anchor hash with more than PART records is spread over several shards; its
pieces cut their sorted window prints into ranges, and each range is merged over the pieces by binary search.

So no shard ever meets all others, a passage that a third of all documents share is split like any other work, and copies
cost one record. Records and prints are told apart by 128 bits.

Defined cases: null and short texts hold nothing to remove; rows are judged as rows, so equal rows, with one doc_id or
none, remove each other's bytes; matches don't cross documents, nor the edges of a text; a text of one repeated pattern
is one record for all its turns; very long texts are worked on in overlapping blocks; an empty table gives an empty one;
columns of other names are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import persisted, slices, table
from .kernels import U64, mix

SEED = 128
BLOCK_BYTES, SHARD_BYTES, PIECE_BYTES, PART, RANGE_BYTES = 1 << 18, 1 << 20, 1 << 19, 1000, 4 << 20
LANES, STRETCH = 4096, 256
_rng = np.random.default_rng(13)
_BYTE = _rng.integers(0, 1 << 63, (2, 256), dtype=np.int64).astype(U64) * U64(2) + U64(1)
_BASE = (U64(0x9E3779B97F4A7C15), U64(0xD1342543DE82EF95))
_powers: dict[tuple[int, bool], np.ndarray] = {}


def _power(which: int, inverse: bool, n: int) -> np.ndarray:
    held = _powers.get((which, inverse))
    if held is None or len(held) < n:
        base = pow(int(_BASE[which]), -1, 1 << 64) if inverse else int(_BASE[which])
        held = np.full(n + n // 4, U64(base))
        held[0] = 1
        _powers[which, inverse] = np.multiply.accumulate(held)
    return _powers[which, inverse][:n]


class Prints:
    """Hashes of any spans of a byte array."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = []
        for which in (0, 1):
            total = np.zeros(n + 1, U64)
            np.cumsum(_BYTE[which][data] * _power(which, False, n), out=total[1:])
            self.sums.append(total)

    def of(self, which: int, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        total = self.sums[which]
        out = (total[starts + lengths] - total[starts]) * _power(which, True, len(total))[starts]
        return mix(out + np.asarray(lengths).astype(U64))


def records(data: np.ndarray, lengths: np.ndarray, length: int, seed: int) -> dict[str, np.ndarray]:
    """Records of consecutive texts in data: text number, first window's place in it, windows, copies in a row, and the
    anchor's and the record's hashes. A record that repeats in a row is listed once, with the number of its copies."""
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return {"text": empty, "lo": empty, "m": empty, "copies": empty, "key": empty, "r1": empty, "r2": empty}
    prints = Prints(data)
    seeds = prints.of(0, np.arange(len(data) - seed + 1), seed)
    least = (seeds & U64(0xFFFFFFFF00000000)) | np.arange(len(seeds)).astype(U64)
    width, size = length - seed + 1, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    n = len(data) - length + 1
    anchors = (np.minimum(least[:n], least[width - size : width - size + n]) & U64(0xFFFFFFFF)).astype(np.int64)
    ends = np.cumsum(lengths)
    text = np.searchsorted(ends, np.arange(n), side="right")
    inside = np.arange(n) + length <= ends[text]
    fresh = np.ones(n, bool)
    fresh[1:] = (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1]) | ~inside[:-1]
    lo = np.flatnonzero(fresh & inside)
    if not len(lo):
        return records(data[:0], lengths[:0], length, seed)
    counted = np.concatenate([[0], np.cumsum(inside)])
    m = np.diff(np.append(counted[lo], counted[-1]))
    span = m + length - 1
    of = text[lo]
    key, r1, r2 = (seeds[anchors[lo]], prints.of(0, lo, span), prints.of(1, lo, span))
    again = np.zeros(len(lo), bool)
    again[1:] = (r1[1:] == r1[:-1]) & (r2[1:] == r2[:-1]) & (key[1:] == key[:-1]) & (of[1:] == of[:-1]) & (lo[1:] == lo[:-1] + m[:-1])
    first = np.flatnonzero(~again)
    copies = np.diff(np.append(first, len(lo)))
    return {"text": of[first], "lo": (lo - (ends - lengths)[of])[first], "m": m[first], "copies": copies, "key": key[first].view(np.int64), "r1": r1[first].view(np.int64), "r2": r2[first].view(np.int64)}


def _scan(length: int, seed: int):
    def emit(rows: list[int], bases: list[int], parts: list[np.ndarray]) -> pa.RecordBatch:
        found = records(np.concatenate(parts), np.array([len(p) for p in parts]), length, seed)
        row, base = np.array(rows)[found["text"]], np.array(bases)[found["text"]]
        columns = {"row": row, "lo": found["lo"] + base, "m": found["m"], "copies": found["copies"], "key": found["key"], "r1": found["r1"], "r2": found["r2"]}
        return pa.record_batch([pa.array(x, pa.int64()) for x in columns.values()], names=list(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, bases, parts, held = [], [], [], 0
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").cast(pa.large_binary())):
                data = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.zeros(0, np.uint8)
                for base in range(0, len(data) - length + 1, BLOCK_BYTES):
                    rows.append(row)
                    bases.append(base)
                    parts.append(data[base : base + BLOCK_BYTES + length - 1].copy())
                    held += len(parts[-1])
                    if held >= BLOCK_BYTES:
                        yield emit(rows, bases, parts)
                        rows, bases, parts, held = [], [], [], 0
        if rows:
            yield emit(rows, bases, parts)

    return run


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Larsson-Sadakane: suffixes sorted by seven bytes, then by ranks at twice the depth, unsorted groups only."""
    n = len(data)
    heads = _words(data, n) & ~U64(255) | np.minimum(np.arange(n, 0, -1), 8).astype(U64)  # an end comes before zero bytes
    order = np.argsort(heads, kind="stable")
    heads = heads[order]
    fresh = np.ones(n, bool)
    fresh[1:] = heads[1:] != heads[:-1]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    at = np.flatnonzero(fresh)
    rank[order] = np.repeat(at, np.diff(np.append(at, n)))
    del heads
    places, depth = np.arange(n), 7
    while True:
        lone = fresh & np.append(fresh[1:], True)
        places, fresh = places[~lone], fresh[~lone]
        if not len(places):
            return order
        own = order[places]
        pairs = rank[own] * (n + 1) + rank[np.minimum(own + depth, n)] + 1
        by = np.argsort(pairs, kind="stable")
        own, pairs = own[by], pairs[by]
        order[places] = own
        fresh = np.ones(len(places), bool)
        fresh[1:] = pairs[1:] != pairs[:-1]
        at = np.flatnonzero(fresh)
        rank[own] = np.repeat(places[at], np.diff(np.append(at, len(places))))
        depth *= 2


def _words(data: np.ndarray, n: int) -> np.ndarray:
    """The eight bytes from each of n places as big-endian numbers, zeros beyond the end."""
    long = np.zeros(n + 8, np.uint8)
    long[: len(data)] = data
    out = np.zeros(n, U64)
    for k in range(8):
        out = out << U64(8) | long[k : k + n]
    return out


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Kasai: of each suffix in the array's order the common prefix with the one before, `most` at the most.

    Runs over up to LANES stretches of the text at once; each stretch starts without knowledge of the one before.
    """
    n = len(data)
    words = _words(data, n + most + 8)
    before = np.empty(n, np.int64)
    before[order[0]] = -1
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    stretch = max(-(-n // LANES), STRETCH)
    at = np.arange(0, n, stretch)
    stop = np.minimum(at + stretch, n)
    known = np.zeros(len(at), np.int64)
    bounds = np.array([1 << (8 * k) for k in range(8)], U64)
    while len(at):
        other = before[at]
        some = other >= 0
        alike = 8 - np.searchsorted(bounds, words[at + known] ^ words[np.maximum(other, 0) + known], side="right")
        known = np.where(some, known + alike, 0)
        over = ~some | (alike < 8) | (known >= most)
        done = at[over]
        shared = np.minimum(np.minimum(known[over], most), n - np.maximum(done, other[over]))
        out[done] = shared
        known[over] = np.maximum(shared - 1, 0)
        at = at + over
        left = at < stop
        if not left.all():
            at, stop, known = at[left], stop[left], known[left]
    return out[order]


def _runs(flags: np.ndarray) -> np.ndarray:
    """(begin, end) of each run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edges.astype("<i4")


_SHARD = "shard long, no int, key long, r1 long, r2 long, spans binary, range long, prints binary, places binary"
_SHARD_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]


def _pieces(key: np.ndarray, spread: np.ndarray, sizes: np.ndarray, most: int) -> list[np.ndarray]:
    """A shard's records in pieces of at most `most` bytes. An anchor hash stays whole, even in a larger piece of its own, if
    it isn't spread; the pieces of one that is meet in the merge."""
    by = np.argsort(key, kind="stable")
    fresh = np.ones(len(by), bool)
    fresh[1:] = (key[by[1:]] != key[by[:-1]]) | (spread[by[1:]] > 1)
    heads = np.flatnonzero(fresh)
    cuts, held = [], 0
    for at, size in zip(heads.tolist(), np.add.reduceat(sizes[by], heads).tolist()):
        if held and held + size > most:
            cuts.append(at)
            held = 0
        held += size
    return np.split(by, cuts)


def _shard(length: int, ranges: int, piece: int = PIECE_BYTES):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        shard, columns = group.column("shard")[0].as_py(), {x: group.column(x).to_numpy() for x in ("key", "r1", "r2", "m", "c", "spread")}
        sizes = columns["m"] + length - 1
        out, base = [], 0
        for rows in _pieces(columns["key"], columns["spread"], sizes, piece):
            data = np.frombuffer(b"".join(group.column("data").take(pa.array(rows)).to_pylist()), np.uint8)
            out += _judged(shard, base, data, {x: column[rows] for x, column in columns.items()}, length, ranges)
            base += len(rows)
        return pa.table([pa.array(x, t) for x, t in zip(zip(*out), _SHARD_TYPES)], names=[x.split()[0] for x in _SHARD.split(", ")])

    return run


def _judged(shard: int, base: int, data: np.ndarray, columns: dict[str, np.ndarray], length: int, ranges: int) -> list[tuple]:
    """Of the records in one piece, numbered from base, the runs of windows that occur twice; of spread ones the prints too."""
    m, c, spread = columns["m"], columns["c"], columns["spread"]
    begin = np.cumsum(m + length - 1) - (m + length - 1)
    order = suffix_array(data)
    equal = np.cumsum(common_prefixes(data, order, length) < length) - 1
    of_place = np.empty(len(data), np.int64)
    of_place[order] = equal
    owner = np.repeat(np.arange(len(m)), m)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(m) - m, m)
    start = begin[owner] + offset
    windows = of_place[start]
    weight = np.bincount(windows, c[owner], minlength=equal[-1] + 1)
    del order, equal, of_place
    twice = weight[windows] > 1
    bounds = np.append(np.searchsorted(owner, np.arange(len(m))), len(owner))
    keys = [columns[x].tolist() for x in ("key", "r1", "r2")]
    out = [(shard, base + no, keys[0][no], keys[1][no], keys[2][no], _runs(twice[bounds[no] : bounds[no + 1]]).tobytes(), None, None, None) for no in range(len(m))]
    split = np.flatnonzero(spread[owner] > 1)
    if len(split):
        split = split[np.unique(windows[split], return_index=True)[1]]  # each distinct window once
        prints = Prints(data)
        both = np.stack([prints.of(which, start[split], length) for which in (0, 1)], 1).astype(">u8")
        texts = np.ascontiguousarray(both).view("S16")[:, 0]
        by = np.argsort(texts, kind="stable")
        texts, split = texts[by], split[by]
        places = np.stack([np.where(twice[split], -1, base + owner[split]), offset[split]], 1).astype("<i4")
        cuts = np.searchsorted(both[by, 0].astype(U64), [U64((k << 64) // ranges) for k in range(ranges)]).tolist() + [len(texts)]
        for k in range(ranges):
            if cuts[k] < cuts[k + 1]:
                out.append((shard, None, None, None, None, None, k, texts[cuts[k] : cuts[k + 1]].tobytes(), places[cuts[k] : cuts[k + 1]].tobytes()))
    return out


def _merge(group: pa.Table) -> pa.Table:
    """Of one range's sorted prints from several pieces those that another piece holds too."""
    runs = [np.frombuffer(x, "S16") for x in group.column("prints").to_pylist()]
    merged = np.sort(np.concatenate(runs))
    out = []
    for shard, texts, places in zip(group.column("shard").to_pylist(), runs, group.column("places").to_pylist()):
        places = np.frombuffer(places, "<i4").reshape(-1, 2)
        shared = np.searchsorted(merged, texts, side="right") - np.searchsorted(merged, texts, side="left") > 1
        found = places[shared & (places[:, 0] >= 0)]
        for no in np.unique(found[:, 0]):
            out.append((shard, int(no), found[found[:, 0] == no, 1].astype("<i4").tobytes()))
    return pa.table([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.binary()))], names=["shard", "no", "more"])


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("key", "r1", "r2", "m", "c", "spread")
        for batch in batches:
            for part in slices(batch, limit=1 << 20):
                out = {x: [] for x in (*names, "data")}
                for text, wanted in zip(part.column("text").cast(pa.large_binary()).to_pylist(), part.column("wanted").to_pylist()):
                    for x in wanted:
                        for name in names:
                            out[name].append(x[name])
                        out["data"].append(text[x["lo"] : x["lo"] + x["m"] + length - 1])
                yield pa.record_batch([*(pa.array(out[x], pa.int64()) for x in names), pa.array(out["data"], pa.binary())], names=list(out))

    return run


def _covered(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts, found = [], []
                for text, marks in zip(part.column("text").cast(pa.large_binary()).to_pylist(), part.column("marks").to_pylist()):
                    text, spans = text or b"", []
                    for mark in marks or ():
                        own = mark["own"] if mark["copies"] == 1 else [{"b": 0, "e": mark["m"] * mark["copies"]}]
                        spans += [(mark["lo"] + x["b"], mark["lo"] + x["e"] - 1 + length) for x in own]
                    removed: list[list[int]] = []
                    for b, e in sorted(spans):
                        if removed and b <= removed[-1][1]:
                            removed[-1][1] = max(e, removed[-1][1])
                        else:
                            removed.append([b, e])
                    found.append([{"begin": b, "end": e} for b, e in removed])
                    edges = [0, *(x for span in removed for x in span), len(text)]
                    texts.append(b"".join(text[b:e] for b, e in zip(edges[::2], edges[1::2])))
                kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
                yield pa.record_batch([part.column("doc"), part.column("n_bytes"), pa.array(found, kind), pa.array(texts, pa.binary())], names=["doc", "n_bytes", "removed", "kept"])

    return run


def repeated_spans(docs: DataFrame, length: int = 400, seed: int = SEED) -> DataFrame:
    """(doc_id, n_bytes, removed, kept) for every row: the maximal runs of bytes (begin, end exclusive) that are covered by
    strings of `length` bytes which also start elsewhere, and the remaining bytes. seed must be less than length."""
    texts = persisted(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"), "texts")
    found = persisted(texts.select("row", "text").mapInArrow(_scan(length, seed), "row long, lo long, m long, copies long, key long, r1 long, r2 long"), "records")
    record = ["key", "r1", "r2"]
    distinct = persisted(found.groupBy(*record).agg(F.sum("copies").alias("c"), F.min(F.struct("row", "lo", "m")).alias("at")), "distinct")
    keys = distinct.groupBy("key").agg(F.count("*").alias("kinds"), F.sum("c").alias("total")).where("total > 1").select(F.col("key").alias("shared"), "kinds")
    shared = persisted(distinct.join(keys, F.col("key") == F.col("shared")).select(*record, "c", "at.*", F.ceil(F.col("kinds") / PART).alias("spread"), "kinds"), "shared")

    many = shared.where("kinds > 1")
    size, split = many.agg(F.sum(F.col("m") + length - 1), F.sum(F.when(F.col("spread") > 1, 16 * F.col("m")))).first()
    whole = lambda col: F.array(F.struct(F.lit(0).alias("b"), col.cast("int").alias("e")))
    spans = shared.where("kinds = 1").select(*record, whole(F.col("m")).alias("own"))
    if size:
        shards, ranges = -(-size // SHARD_BYTES), -(-(split or 0) // RANGE_BYTES)
        wanted = many.groupBy("row").agg(F.collect_list(F.struct("lo", *record, "m", "c", "spread")).alias("wanted"))
        cut = texts.join(wanted, "row").select("text", "wanted").mapInArrow(_cut(length), "key long, r1 long, r2 long, m long, c long, spread long, data binary")
        dealt = cut.withColumn("shard", F.pmod(F.xxhash64("key", F.pmod("r1", "spread")), F.lit(shards)))
        judged = persisted(dealt.groupBy("shard").applyInArrow(_shard(length, max(ranges, 1), PIECE_BYTES), _SHARD), "judged")
        own = judged.where("no is not null")
        if ranges:
            more = judged.where("range is not null").select("shard", "range", "prints", "places").groupBy("range").applyInArrow(_merge, "shard long, no int, more binary")
            more = more.groupBy("shard", "no").agg(F.collect_list("more").alias("more"))
            own = own.join(more, ["shard", "no"], "left")
        else:
            own = own.withColumn("more", F.lit(None).cast("array<binary>"))
        spans = spans.unionByName(own.select(*record, "spans", "more").mapInArrow(_joined, "key long, r1 long, r2 long, own array<struct<b:int,e:int>>"))
    spans = persisted(spans, "spans")

    marks = found.join(spans, record).groupBy("row").agg(F.collect_list(F.struct("lo", "m", "copies", "own")).alias("marks"))
    out = texts.join(marks, "row", "left").select(F.col("doc_id").alias("doc"), "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "marks")
    return out.mapInArrow(_covered(length), "doc long, n_bytes long, removed array<struct<begin:long,end:long>>, kept binary").withColumnRenamed("doc", "doc_id")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each record's runs of repeated windows, from its shard's and from the merge; records without any go."""
    kind = pa.list_(pa.struct([("b", pa.int32()), ("e", pa.int32())]))
    for batch in batches:
        kept, own = [], []
        for i, (spans, more) in enumerate(zip(batch.column("spans").to_pylist(), batch.column("more").to_pylist())):
            runs = [(int(b), int(e)) for b, e in np.frombuffer(spans, "<i4").reshape(-1, 2)]
            for x in more or ():
                runs += [(int(b), int(b) + 1) for b in np.frombuffer(x, "<i4")]
            if runs:
                kept.append(i)
                own.append([{"b": b, "e": e} for b, e in sorted(runs)])
        columns = batch.select(["key", "r1", "r2"]).take(pa.array(kept, pa.int64())).columns
        yield pa.record_batch([*columns, pa.array(own, kind)], names=["key", "r1", "r2", "own"])


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans(table(spark, sf_dir, "documents"), length=400)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["begin"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
