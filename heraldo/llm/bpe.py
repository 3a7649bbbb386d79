"""Byte-level BPE encoding and decoding over a global shuffle of distinct words.

Texts are taken in batches of about BATCH_BYTES. A batch's pre-tokens (the pattern's matches) become its distinct words
with slots and, per document, the slots in order of position. The (batch, slot, word) rows are shuffled by word, so all
batches' uses of a word meet and it is encoded once; its ids go back to their batches, are joined to the positions there
and put in order. A word has one row per batch, so a word that makes up a third of all text is as small as any other.
Decoding joins the ids to the token-byte table (one row per token, as many as the vocabulary has).

Splitting into pre-tokens is done once per distinct space-separated chunk of a batch: a match never continues from a
non-space into white space, so a chunk with its leading space is split alike wherever it stands. Texts in which a chunk
ends in other white space or is empty are split whole.

The batches are cut from the rows as the input's partitions have them, in both passes over them, so the input must be a
stored table; a batch whose number of words differs between the passes is an error.

Defined cases: null is encoded as the empty text; an empty text has no ids; rows are encoded one by one, so repeated rows
and repeated doc_ids stay; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

BATCH_BYTES = 16 << 20
#: \s and \S as the encoder's own regular expressions have them.
_SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _splitter(pattern: str) -> Callable[[str], list[str]]:
    inside = pattern.replace(r"[^\s", f"[^{_SPACES}")
    return regex.compile(inside.replace(r"\S", f"[^{_SPACES}]").replace(r"\s", f"[{_SPACES}]")).findall


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file's tokens: base64 of the bytes and the rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _split_batch(column: pa.Array, split: Callable[[str], list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct pre-tokens of a batch of texts, and for each text the number of its pre-tokens and, all in a row, their slots."""
    texts = pc.fill_null(column, "")
    chunks = pc.split_pattern(texts, " ")
    bounds = np.asarray(chunks.offsets).astype(np.int64)
    coded = chunks.flatten().dictionary_encode()
    bounds = bounds - bounds[0]
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    slot: dict[str, int] = defaultdict(count().__next__)
    flat: list[int] = []
    sizes: list[int] = []

    def add(piece: str) -> None:
        found = split(piece)
        flat.extend(map(slot.__getitem__, found))
        sizes.append(len(found))

    distinct = coded.dictionary.to_pylist()
    open_end = np.array([not x or x[-1].isspace() for x in distinct], bool) if distinct else np.zeros(0, bool)
    for chunk in distinct:
        add(" " + chunk)
    n = len(column)
    whole = np.zeros(n, bool)
    if len(codes):
        bad = open_end[codes]
        bad[bounds[1:] - 1] = False  # a last chunk may end anyhow
        total = np.concatenate([[0], np.cumsum(bad)])
        whole = total[bounds[1:]] > total[bounds[:-1]]
    keep = np.ones(len(codes), bool)
    for d in np.flatnonzero(whole):
        keep[bounds[d] + 1 : bounds[d + 1]] = False
    values = texts.to_pylist()
    for d in range(n):  # every text's first chunk has no leading space
        codes[bounds[d]] = len(sizes)
        add(values[d] if whole[d] else values[d].partition(" ")[0])
    size_of = np.array(sizes, np.int64)
    begin_of = np.concatenate([[0], np.cumsum(size_of)])
    per_chunk = np.where(keep, size_of[codes], 0)
    ends = np.concatenate([[0], np.cumsum(per_chunk)])
    at = np.arange(ends[-1]) + np.repeat(begin_of[codes] - ends[:-1], per_chunk)
    return list(slot), ends[bounds[1:]] - ends[bounds[:-1]], np.array(flat, np.uint32)[at]


def _pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays as compressed bytes, the four bytes of each number apart."""
    head = np.array([len(arrays), *map(len, arrays)], "<i8").tobytes()
    return zstandard.compress(head + b"".join(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for x in arrays), 1)


def _unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    (n,) = np.frombuffer(raw, "<i8", 1)
    out, at = [], 8 * (n + 1)
    for size in np.frombuffer(raw, "<i8", n, 8).tolist():
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * size, at).reshape(4, -1).T).view("<u4").reshape(-1))
        at += 4 * size
    return out


def _digest(words: list[str]) -> bytes:
    return hashlib.sha256("\x00".join(words).encode()).digest()


def _pass(pattern: str, positions: bool):
    """One of the two passes over the texts: the distinct words of each batch, or the positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, numbers = _splitter(pattern), count(TaskContext.get().partitionId() << 24)
        for batch in batches:
            for part in slices(batch, limit=BATCH_BYTES):
                number = next(numbers)
                words, sizes, slots = _split_batch(part.column("text"), split)
                if positions:
                    ids = part.column("doc_id")
                    plain = pc.fill_null(ids, 0).to_numpy().astype(np.int64).view("<u4")
                    yield pa.record_batch([pa.array([number]), pa.array([_digest(words)], pa.binary()), pa.array([_pack(plain, np.asarray(ids.is_valid()).astype(np.uint32), sizes, slots, np.array([len(words)]))], pa.binary())], names=["batch", "words", "blob"])
                else:
                    yield pa.record_batch([pa.array(np.full(len(words), number)), pa.array(np.arange(len(words), dtype=np.int32)), pa.array(words, pa.string())], names=["batch", "slot", "word"])

    return run


def _encoder(ranks: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})


def _encode_words(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(shared.value).encode_ordinary
        known: dict[str, list[int]] = {}
        for batch in batches:
            coded = batch.column("word").dictionary_encode()
            ids = []
            for word in coded.dictionary.to_pylist():
                if (found := known.get(word)) is None:
                    found = known[word] = encode(word)
                ids.append(found)
            sizes = np.array([len(x) for x in ids], np.int64)
            flat = np.array([y for x in ids for y in x], np.uint32)
            begin = np.concatenate([[0], np.cumsum(sizes)])
            codes = coded.indices.to_numpy(zero_copy_only=False)
            owner, slots = batch.column("batch").to_numpy(), batch.column("slot").to_numpy()
            order = np.lexsort((slots, owner))
            owner, slots, codes = owner[order], slots[order], codes[order]
            edges = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]])) if len(owner) else np.zeros(1, int)
            blobs = []
            for a, b in zip(edges[:-1], edges[1:]):
                n = sizes[codes[a:b]]
                at = np.arange(n.sum()) + np.repeat(begin[codes[a:b]] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
                blobs.append(_pack(np.diff(slots[a:b], prepend=0), n, flat[at]))
            yield pa.record_batch([pa.array(owner[edges[:-1]]), pa.nulls(len(blobs), pa.binary()), pa.array(blobs, pa.binary())], names=["batch", "words", "blob"])

    return run


def _gather(values: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - sizes), sizes)]


def _reassemble(emit: Callable[[list, Iterator[np.ndarray], object], pa.Table], shared):
    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        heads = [r for r in rows if r["words"] is not None]
        if len(heads) != 1:
            raise RuntimeError("the input's batches differ between the passes; give a stored table")
        packs = [_unpack(r["blob"]) for r in rows if r["words"] is None]
        plain, valid, sizes, slots, n_words = _unpack(heads[0]["blob"])
        doc_ids = [int(x) if v else None for x, v in zip(np.ascontiguousarray(plain).view("<i8"), valid)]
        slot_of = np.concatenate([np.cumsum(p[0].astype(np.int64)) for p in packs]) if packs else np.zeros(0, np.int64)
        if len(slot_of) != n_words[0]:  # words that stand only at the start or only inside texts have slots that nothing uses
            raise RuntimeError("the input's batches differ between the passes; give a stored table")
        n_of = np.concatenate([p[1] for p in packs]).astype(np.int64) if packs else np.zeros(0, np.int64)
        ids = np.concatenate([p[2] for p in packs]) if packs else np.zeros(0, "<u4")
        begin = np.zeros(len(slot_of), np.int64)
        size = np.zeros(len(slot_of), np.int64)
        begin[slot_of], size[slot_of] = np.cumsum(n_of) - n_of, n_of
        edges = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
        per_doc = (_gather(ids, begin[s], size[s]) for s in (slots[a:b] for a, b in zip(edges[:-1], edges[1:])))
        return emit(doc_ids, per_doc, shared)

    return run


def _encoded(docs: DataFrame, ranks: dict[bytes, int], pattern: str, emit, schema: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    words = texts.mapInArrow(_pass(pattern, False), "batch long, slot int, word string")
    ids = words.repartition(F.col("word")).mapInArrow(_encode_words(shared), "batch long, words binary, blob binary")
    places = texts.mapInArrow(_pass(pattern, True), "batch long, words binary, blob binary")
    return places.unionByName(ids).groupBy("batch").applyInArrow(_reassemble(emit, shared), schema)


def _ids_table(doc_ids, per_doc, _shared) -> pa.Table:
    return pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "ids": pa.array([x.astype(np.int32) for x in per_doc], pa.list_(pa.int32()))})


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(doc_id, ids) for every row of docs."""
    return _encoded(docs, ranks, pattern, _ids_table, "doc_id long, ids array<int>")


class TokenBytes:
    """The token-byte table: the bytes of token i are data[begin[i]:begin[i] + size[i]]."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = sorted(ranks, key=ranks.__getitem__)
        self.size = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
        self.size[[ranks[t] for t in tokens]] = [len(t) for t in tokens]
        self.begin = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        return _gather(self.data, self.begin[ids], self.size[ids]).tobytes()


_tables: dict[int, TokenBytes] = {}


def token_bytes(shared) -> TokenBytes:
    """The table of a broadcast vocabulary, built once per worker."""
    ranks = shared.value
    if id(ranks) not in _tables:
        _tables.clear()
        _tables[id(ranks)] = TokenBytes(ranks)
    return _tables[id(ranks)]


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, data): the bytes that the ids of (doc_id, ids) stand for. Ids without a token are an error."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to_bytes = token_bytes(shared).decode
            data = [None if x is None else to_bytes(np.array(x, np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def _digests(doc_ids, per_doc, shared) -> pa.Table:
    to_bytes = token_bytes(shared).decode
    sizes, of_ids, of_bytes = [], [], []
    for ids in per_doc:
        sizes.append(len(ids))
        of_ids.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
        of_bytes.append(hashlib.sha256(to_bytes(ids.astype(np.int64))).hexdigest())
    return pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "n_tokens": pa.array(sizes, pa.int64()), "ids_sha256": pa.array(of_ids, pa.string()), "decoded_sha256": pa.array(of_bytes, pa.string())})


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text encoded, decoded again, and digested in one go."""
    return _encoded(docs, ranks, pattern, _digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def round_trip(docs: DataFrame) -> DataFrame:
    """digests() with the public vocabulary."""
    import public_tokenizers

    return digests(docs, read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
