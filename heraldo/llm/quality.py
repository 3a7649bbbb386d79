"""Quality rules by repetition coverage.

For every document, rolling hashes of several n-gram lengths (numpy, over all texts of an Arrow slice at once) give the
characters that lie inside duplicated n-grams, the weight of the most common short n-grams, and the characters of
duplicated lines. A document is kept if the base rules and all coverage limits hold.

Defined cases: null and empty texts have no words and fail the base rules; rows are judged one by one, so repeated rows
get equal results; other columns pass through `filter_documents` untouched and are ignored by `measure`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table
from .kernels import NON_SPACE, U64, gram_hashes, mix, words_of

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Largest share of a text's word characters in the most common n-gram, and inside n-grams that occur twice or more.
TOP_LIMITS = {2: 0.20, 3: 0.18, 4: 0.16}
DUP_LIMITS = {5: 0.50, 6: 0.49, 7: 0.48, 8: 0.47, 9: 0.46, 10: 0.45}
#: Largest share of the lines, and of the lines' characters, that repeat an earlier line.
LINE_LIMIT, LINE_CHARS_LIMIT = 0.30, 0.30

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, top_share double, dup_share double, dup_line_share double"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _covered(first: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n words lie in a window of `size` words that begins at one of `first`."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, np.minimum(first + size, n), -1)
    return np.cumsum(edge[:-1]) > 0


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values that occur twice or more, and how often."""
    ordered = np.sort(keys)
    edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]])) if len(ordered) else np.zeros(1, int)
    counts = np.diff(edges)
    return ordered[edges[:-1][counts > 1]], counts[counts > 1]


def _lookup(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is among the sorted values, and where."""
    if not len(values):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(values, keys), len(values) - 1)
    return values[at] == keys, at


def coverage(column: pa.Array) -> dict[str, np.ndarray]:
    """The measures of SCHEMA for each text of a column."""
    n = len(column)
    words = words_of(column, NON_SPACE, lower=False)
    chars_before = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    word_chars = (chars_before[words.ends] - chars_before[words.starts]).astype(np.int64)
    docs, n_words = words.docs, np.diff(words.first)
    total = np.bincount(docs, word_chars, n)
    symbols_before = np.concatenate([[0], np.cumsum(_SYMBOL[words.data])])
    n_symbols = np.diff(symbols_before[words.offsets])
    salt = mix(np.arange(n).astype(U64) + U64(0x51ED270B))
    chars_of = np.concatenate([[0], np.cumsum(word_chars)])

    def shared(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes, at = gram_hashes(words, size)
        keys = hashes ^ salt[docs[at]]
        values, counts = _repeated(keys)
        hit, where = _lookup(keys, values)
        return at[hit], counts[where[hit]] if len(counts) else np.zeros(0, int), hit

    share = lambda x: np.divide(x, total, out=np.zeros(n), where=total > 0)
    over = np.zeros(n, bool)
    top_share, dup_share = np.zeros(n), np.zeros(n)
    for size, limit in TOP_LIMITS.items():
        first, counts, _ = shared(size)
        weight = counts * (chars_of[first + size] - chars_of[first])
        top = np.zeros(n)
        np.maximum.at(top, docs[first], weight)
        over |= share(top) > limit
        top_share = np.maximum(top_share, share(top))
        if size == 3:
            n_repeat = np.bincount(docs[_covered(first, size, len(docs))], minlength=n)
    for size, limit in DUP_LIMITS.items():
        first, _, _ = shared(size)
        inside = _covered(first, size, len(docs))
        part = share(np.bincount(docs[inside], word_chars[inside], n))
        over |= part > limit
        dup_share = np.maximum(dup_share, part)
        if not inside.any():  # longer windows can't repeat if shorter ones don't
            break

    n_dup, dup_line_share = np.zeros(n, np.int64), np.zeros(n)
    for i, text in enumerate(column.to_pylist()):
        seen: set[str] = set()
        lines = chars = dup_chars = 0
        for line in (text or "").split("\n"):
            if not line.strip(" \t\n\x0b\x0c\r"):
                continue
            lines, chars = lines + 1, chars + len(line)
            if line in seen:
                n_dup[i], dup_chars = n_dup[i] + 1, dup_chars + len(line)
            seen.add(line)
        if lines:
            over[i] |= n_dup[i] > LINE_LIMIT * lines or dup_chars > LINE_CHARS_LIMIT * chars
            dup_line_share[i] = dup_chars / chars
    failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
    return {"n_words": n_words, "word_chars": total.astype(np.int64), "n_symbols": n_symbols, "n_dup_lines": n_dup, "n_repeat_words": n_repeat, "base_failed": failed, "kept": ~failed & ~over, "top_share": top_share, "dup_share": dup_share, "dup_line_share": dup_line_share}


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            found = coverage(part.column("text"))
            yield pa.record_batch([part.column("doc_id"), *(pa.array(x) for x in found.values())], names=["doc_id", *found])


def measure(docs: DataFrame) -> DataFrame:
    """The measures and the verdict for every row of (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_measure, SCHEMA)


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows whose text passes, with all their columns, judged where they are: nothing is shuffled or joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(coverage(part.column("text"))["kept"]))

    return docs.mapInArrow(run, docs.schema)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return measure(table(spark, sf_dir, "documents")).select(columns)
