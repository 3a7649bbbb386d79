"""Token ids in binary, one zstandard frame per document under a shared dictionary.

Format: a Parquet table of packs, each a run of documents in ascending doc_id order (shard, pack, dictionary hash, first id
width, doc_ids, offsets into the payload, token counts, payload). A document's frame is payload[offsets[i]:offsets[i + 1]],
decompressed with the dictionary of that hash, which is a second small table beside it; so a short document is read by
its own few bytes. Documents are range-partitioned by doc_id, encoded where they then are and written by Spark's
committer: a lost executor costs its partitions.

The dictionary is trained on a bounded sample: the SAMPLE documents with the least hash of doc_id and text, SAMPLE_CHARS
of each. Everything else covers all documents.

Encoding: a text's chunks between spaces are encoded apart (white space never lies within one of the tokenizer's words),
each distinct chunk of a slice once, and letters with closing signs as letters and signs.

Defined cases: null is the empty text, which is stored as the end id alone; equal doc_ids follow each other by a hash
of the text; a null doc_id comes first; an empty table gives an empty store; a very long text is encoded and compressed
whole, in one task; columns of any other name are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, slices, table, text_bytes

END_ID = 2
SAMPLE, SAMPLE_CHARS, DICT_BYTES, LEVEL = 2048, 8192, 64 << 10, 3
PACK_BYTES, PARTITION_BYTES = 4 << 20, 32 << 20
CACHE = 600_000
BLOCK = 1024
PACKS = "shard long, pack int, dict_sha256 string, width int, doc_ids array<long>, offsets array<long>, counts array<int>, payload binary"
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?#*$%&]*)").fullmatch


class TextEncoder:
    """A tokenizer of the tokenizers library over whole texts, with each distinct chunk encoded once."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        size = self.tokenizer.get_vocab_size()
        self.word_end = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.known: dict[str, bytes] = {}

    def _learn(self, chunks: list[str]) -> None:
        """Encodes chunks that aren't known yet. Words of letters go through together: each ends in a word-end token."""
        if len(self.known) > CACHE:
            self.known.clear()
        known = self.known
        missing = [c for c in chunks if c not in known]
        bare = [c for c in missing if c.isascii() and c.isalpha()]
        others = [c for c in missing if not (c.isascii() and c.isalpha())]
        signed, rest = [], []
        for c in others:
            if m := _PLAIN(c):
                signed.append((c, *m.groups()))
            else:
                rest.append(c)
        parts = {w for _, word, signs in signed for w in (word, signs)}
        words = bare + list(parts.difference(bare, ("",))) or ["."]
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.word_end[ids]) + 1
        if len(ends) == len(words) and ends[-1] == len(ids):
            raw, bounds = ids.tobytes(), (4 * ends).tolist()
            pieces = [raw[a:b] for a, b in zip([0, *bounds], bounds)]
            known.update(zip(bare, pieces))
            of = dict(zip(words, pieces)) if signed else {}
            of[""] = b""
            known.update((c, of[word] + of[signs]) for c, word, signs in signed)
        else:
            rest = missing
        for c, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False) if rest else ()):
            known[c] = np.array(e.ids, "<u4").tobytes()

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, with the end id."""
        chunks = pc.split_pattern(pc.replace_substring(pc.fill_null(column, ""), "\n", " "), " ")
        bounds = np.asarray(chunks.offsets).astype(np.int64)
        coded = chunks.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        bounds = bounds - bounds[0]
        self._learn(distinct)
        lists = [self.known[c] for c in distinct]
        size = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        flat = np.frombuffer(b"".join(lists), "<u4")
        begin = np.cumsum(size) - size
        n = size[codes]
        ends = np.concatenate([[0], np.cumsum(n)])
        every = flat[np.arange(ends[-1]) + np.repeat(begin[codes] - ends[:-1], n)]
        for a, b in zip(ends[bounds[:-1]], ends[bounds[1:]]):
            yield np.append(every[a:b], np.uint32(END_ID))


_encoders: dict[str, TextEncoder] = {}


def _encoder(definition: str) -> TextEncoder:
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = TextEncoder(definition)
    return _encoders[key]


def train_dictionary(docs: DataFrame, definition: str, width: int) -> bytes:
    """A zstandard dictionary from the sample's serialized ids; with too little to train on, the ids themselves."""
    picked = docs.select(F.substring(F.coalesce("text", F.lit("")), 1, SAMPLE_CHARS).alias("text"), F.xxhash64("doc_id", "text").alias("h")).orderBy("h").limit(SAMPLE).select("text").toArrow()
    encoder = _encoder(definition)
    samples = [x.astype(f"<u{width}").tobytes() for chunk in picked.column("text").chunks for x in encoder.encode(chunk)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICT_BYTES:]


def write_store(docs: DataFrame, definition: str, path: str) -> None:
    """Encodes (doc_id, text) and writes the packs to path/packs and the dictionary to path/dictionary."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    vocabulary = _encoder(definition).tokenizer.get_vocab_size()
    width = 2 if vocabulary <= 1 << 16 else 4
    dictionary = train_dictionary(texts, definition, width)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary))], "dict_sha256 string, data binary").coalesce(1).write.parquet(f"{path}/dictionary")
    shared = spark.sparkContext.broadcast((definition, dictionary))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        definition, dictionary = shared.value
        encoder = _encoder(definition)
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary)).compress
        shard, number = TaskContext.get().partitionId(), 0
        ids, counts, frames = [], [], []

        def flush() -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype(np.int64)
            row = [[shard], [number], [digest], [width], [list(ids)], [offsets], [list(counts)], [b"".join(frames)]]
            types = [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            return pa.record_batch([pa.array(x, t) for x, t in zip(row, types)], names=[x.split()[0] for x in PACKS.split(", ")])

        held = 0
        for batch in batches:
            for part in slices(batch):
                for doc, tokens in zip(part.column("doc_id").to_pylist(), encoder.encode(part.column("text"))):
                    ids.append(doc)
                    counts.append(len(tokens))
                    frames.append(compress(tokens.astype(f"<u{width}").tobytes()))
                    held += len(frames[-1])
                    if held >= PACK_BYTES:
                        yield flush()
                        ids, counts, frames, held, number = [], [], [], 0, number + 1
        if ids:
            yield flush()

    n = max(spark.sparkContext.defaultParallelism, -(-text_bytes(texts) // PARTITION_BYTES))
    keyed = texts.withColumn("hash", F.xxhash64("text"))  # rows of one doc_id can lie in several partitions
    ordered = keyed.repartitionByRange(n, "doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text").select("doc_id", "text")
    ordered.mapInArrow(pack, PACKS).write.option("compression", "none").parquet(f"{path}/packs")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored document, all read from its frame."""
    packs = spark.read.schema(PACKS).parquet(f"{path}/packs")
    # the dictionary table has one row of DICT_BYTES at most
    digest, dictionary = spark.read.parquet(f"{path}/dictionary").first()
    shared = spark.sparkContext.broadcast((digest, bytes(dictionary)))
    sizes = packs.select("shard", "pack", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))
    sizes = sizes.withColumn("block", F.floor(F.col("shard") / BLOCK))
    before = lambda w: F.coalesce(F.sum("total").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    # one row for BLOCK partitions of the table, so the window over all of them orders next to nothing
    blocks = sizes.groupBy("block").agg(F.sum("total").alias("total")).select("block", before(Window.orderBy("block")).alias("ahead"))
    within = sizes.select("shard", "pack", "block", before(Window.partitionBy("block").orderBy("shard", "pack")).alias("base"))
    starts = within.join(blocks, "block").select("shard", "pack", (F.col("ahead") + F.col("base")).alias("base"))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, dictionary = shared.value
        decompress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).decompress
        for batch in batches:
            for row in batch.to_pylist():
                if row["dict_sha256"] != digest:
                    raise RuntimeError("a pack names another dictionary")
                start, out = row["base"], []
                for i, doc in enumerate(row["doc_ids"]):
                    ids = np.frombuffer(decompress(row["payload"][row["offsets"][i] : row["offsets"][i + 1]]), f"<u{row['width']}").astype("<u4")
                    out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
                    start += len(ids)
                yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*out)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return packs.join(starts, ["shard", "pack"]).mapInArrow(unpack, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        definition = file.read()
    path = scratch(spark, "token-store")
    write_store(table(spark, sf_dir, "documents"), definition, path)
    return read_store(spark, path)
