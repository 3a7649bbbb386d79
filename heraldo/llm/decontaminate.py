"""Benchmark decontamination with a generalised suffix automaton.

The normalised items are sequences of words; one automaton over word numbers recognises every substring of every item.
Training words are streamed through it and the longest matching length is tracked: wherever it reaches WINDOW words (or
a whole shorter item), the words of that window are hit. A document is contaminated if it has hits and they cover at
least 1/COVERAGE of its words; such documents are dropped. In the others every hit span is cut out of the text.

Items are dealt by hash into blocks of about BLOCK_WORDS words; an item is never split. The driver builds, sends and
releases one block at a time. Between blocks the rows are stored with their hits so far, which the next block's pass
unites with its own; the last pass gives the result, so a single block needs no storing.

Only runs of consecutive words that all occur in the block's items, at least as long as its shortest window, enter the
automaton: any other word resets the match to nothing. Which words these are is found by their 64-bit hashes in numpy.

Defined cases: null, empty and wordless texts have no words, no hits and are not contaminated; items without words are
ignored; equal items each count; without items nothing is hit; rows are judged one by one; columns of any name pass
through `filter_documents`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructField, StructType

from .common import persisted, released, slices, table
from .kernels import ALNUM, Words, words_of

WINDOW, COVERAGE = 13, 20
BLOCK_WORDS = 500_000
HITS, ITEMS = "__hits", "__items"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class Automaton:
    """Generalised suffix automaton of word sequences, with what a window's state needs: the items it occurs in."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.window = window
        self.shortest = min((min(len(words), window) for _, words in items), default=window)
        ends: list[set[str]] = [set()]
        for item, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
                while len(ends) < len(self.next):
                    ends.append(set())
                ends[last].add(item)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.length[self.link[state]] >= window:  # shorter substrings are no windows
                ends[self.link[state]] |= ends[state]
            elif self.length[state] >= window:
                continue
        #: For each state the items of the window that ends there, if its words reach that far back.
        self.items: list[frozenset[str]] = [frozenset()] * len(self.next)
        #: For each state the shorter items that end there: (words, item).
        self.short: list[tuple[tuple[int, str], ...]] = [()] * len(self.next)
        whole: dict[int, list[tuple[int, str]]] = {}
        for item, words in items:
            if len(words) < window:
                state = 0
                for word in words:
                    state = self.next[state][word]
                whole.setdefault(state, []).append((len(words), item))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            above = self.link[state]
            self.short[state] = self.short[above] + tuple(whole.get(state, ()))
            if self.length[state] >= window:
                self.items[state] = frozenset(ends[state]) if self.length[above] < window else self.items[above]

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if (q := nxt[last].get(word)) is not None:
            return q if length[q] == length[last] + 1 else self._clone(last, word, q)
        state = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and word not in nxt[p]:
            nxt[p][word] = state
            p = link[p]
        if p >= 0:
            q = nxt[p][word]
            link[state] = q if length[q] == length[p] + 1 else self._clone(p, word, q)
        return state

    def _clone(self, p: int, word: int, q: int) -> int:
        clone = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def hits(self, words: list[int], at: int, hit: np.ndarray, found: set[str]) -> None:
        """Streams words (the first is number `at` of the text) and marks the hit ones; found gets the items."""
        state = matched = 0
        nxt, link, length, window = self.next, self.link, self.length, self.window
        for i, word in enumerate(words, at):
            while (to := nxt[state].get(word)) is None and state:
                state = link[state]
                matched = length[state]
            if to is None:
                matched = 0
                continue
            state, matched = to, matched + 1
            if matched >= window:
                hit[i - window + 1 : i + 1] = True
                found |= self.items[state]
            for size, item in self.short[state]:
                if size <= matched:
                    hit[i - size + 1 : i + 1] = True
                    found.add(item)


class Block:
    """An automaton and the hashes of its words, as sent to the tasks."""

    def __init__(self, ids: pa.Array, texts: pa.Array, window: int):
        words = words_of(texts, ALNUM, lower=True)
        self.known, numbers = np.unique(words.hashes, return_inverse=True)
        spans = zip(ids.to_pylist(), words.first[:-1], words.first[1:])
        self.automaton = Automaton([(str(i), numbers[a:b].tolist()) for i, a, b in spans if b > a], window)

    def search(self, words: Words) -> tuple[np.ndarray, list[set[str]]]:
        """Which words are hit, and for each text the items with windows in it."""
        hit, found = np.zeros(len(words.hashes), bool), [set() for _ in words.first[1:]]
        if not len(self.known) or not len(words.hashes):
            return hit, found
        number = np.minimum(np.searchsorted(self.known, words.hashes), len(self.known) - 1)
        inside = self.known[number] == words.hashes
        docs = words.docs
        same = np.zeros(len(inside), bool)
        same[1:] = inside[1:] & inside[:-1] & (docs[1:] == docs[:-1])
        begins = np.flatnonzero(inside & ~same)
        ends = np.flatnonzero(inside & ~np.append(same[1:], False)) + 1
        long = ends - begins >= self.automaton.shortest
        for a, b in zip(begins[long], ends[long]):
            self.automaton.hits(number[a:b].tolist(), int(a), hit, found[docs[a]])
        return hit, found


def _dealt(items: DataFrame, block_words: int) -> tuple[DataFrame, list[int]]:
    """The items (item_id, text, block), and the numbers of the blocks."""
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.size(F.regexp_extract_all("text", F.lit(_WORD), F.lit(0))))).first()[0] or 0
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, -(-size // block_words)))))
    return dealt, sorted(r[0] for r in dealt.select("block").distinct().collect())


def _block(dealt: DataFrame, number: int, window: int) -> Block:
    batch = dealt.where(F.col("block") == number).select("item_id", "text").toArrow().combine_chunks().to_batches()[0]
    return Block(batch.column("item_id"), batch.column("text"), window)


def _searched(part: pa.RecordBatch, words: Words, block: Block | None) -> tuple[np.ndarray, list[set[str]]]:
    """The block's hits and items, with those of earlier blocks that the rows bring along."""
    hit, found = block.search(words) if block else (np.zeros(len(words.hashes), bool), [set() for _ in words.first[1:]])
    if HITS in part.schema.names:
        for i, (bits, items) in enumerate(zip(part.column(HITS).to_pylist(), part.column(ITEMS).to_pylist())):
            if bits:
                a, b = words.first[i], words.first[i + 1]
                hit[a:b] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=int(b - a)).astype(bool)
                found[i] |= set(items)
    return hit, found


def _passes(docs: DataFrame, items: DataFrame, window: int, block_words: int, finish: Callable, schema) -> DataFrame:
    """finish(part, words, hit, found) of every slice of docs, with the hits of all blocks."""
    context = docs.sparkSession.sparkContext
    dealt, numbers = _dealt(items, block_words)
    columns = docs.columns

    def over(shared, then):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch):
                    words = words_of(part.column("text"), ALNUM, lower=True)
                    yield then(part, words, *_searched(part, words, shared.value))

        return run

    def keep(part: pa.RecordBatch, words: Words, hit: np.ndarray, found: list[set[str]]) -> pa.RecordBatch:
        bits = [np.packbits(hit[a:b]).tobytes() if x else None for a, b, x in zip(words.first[:-1], words.first[1:], found)]
        new = {HITS: pa.array(bits, pa.binary()), ITEMS: pa.array([sorted(x) for x in found], pa.list_(pa.string()))}
        return pa.record_batch([*(part.column(c) for c in columns), *new.values()], names=[*columns, *new])

    rows, marked = docs, StructType([*docs.schema.fields, StructField(HITS, BinaryType()), StructField(ITEMS, ArrayType(StringType()))])
    for i, number in enumerate(numbers[:-1]):
        shared = context.broadcast(_block(dealt, number, window))
        more = persisted(rows.mapInArrow(over(shared, keep), marked), "hits")
        shared.destroy()
        if i:
            released(rows)
        rows = more
    return rows.mapInArrow(over(context.broadcast(_block(dealt, numbers[-1], window) if numbers else None), finish), schema)


def _per_doc(flags: np.ndarray, words: Words) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[words.first[1:]] - total[words.first[:-1]]


SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest long"


def judge(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: int = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """For every row of docs the words, hit words, items and verdict of SCHEMA; longest: the longest hit span in words."""

    def finish(part: pa.RecordBatch, words: Words, hit: np.ndarray, found: list[set[str]]) -> pa.RecordBatch:
        n_words, n_hit = np.diff(words.first), _per_doc(hit, words)
        digest = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in found]
        longest = np.zeros(len(found), np.int64)
        begins, ends = _spans(hit, words)
        np.maximum.at(longest, words.docs[begins], ends - begins)
        columns = [part.column("doc_id"), n_words, n_hit, np.array([len(x) for x in found], np.int64), digest, (n_hit > 0) & (coverage * n_hit >= n_words), longest]
        return pa.record_batch([pa.array(x) if not isinstance(x, pa.Array) else x for x in columns], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return _passes(docs.select(F.col("doc_id").cast("long"), "text"), items, window, block_words, finish, SCHEMA)


def _spans(hit: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last words of the hit spans; a span stays in one text."""
    docs = words.docs
    joined = np.zeros(len(hit), bool)
    joined[1:] = hit[1:] & hit[:-1] & (docs[1:] == docs[:-1])
    return np.flatnonzero(hit & ~joined), np.flatnonzero(hit & ~np.append(joined[1:], False)) + 1 if len(hit) else np.zeros(0, np.int64)


def filter_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: int = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs without the contaminated ones; in the rest the hit spans are cut out and n_chars, if there, is brought up to date."""
    docs_columns = docs.columns

    def finish(part: pa.RecordBatch, words: Words, hit: np.ndarray, found: list[set[str]]) -> pa.RecordBatch:
        n_words, n_hit = np.diff(words.first), _per_doc(hit, words)
        begins, ends = _spans(hit, words)
        cuts: dict[int, list[tuple[int, int]]] = {}
        for a, b in zip(begins, ends):
            d = int(words.docs[a])
            base = int(words.offsets[d])
            cuts.setdefault(d, []).append((int(words.starts[a]) - base, int(words.ends[b - 1]) - base))
        if cuts:
            texts = part.column("text").to_pylist()
            for d, spans in cuts.items():
                raw, at, kept = texts[d].encode(), 0, []
                for a, b in spans:
                    kept.append(raw[at:a])
                    at = b
                texts[d] = b"".join([*kept, raw[at:]]).decode()
            part = part.set_column(part.schema.get_field_index("text"), "text", pa.array(texts, part.column("text").type))
        return part.select(docs_columns).filter(pa.array(~((n_hit > 0) & (coverage * n_hit >= n_words))))

    out = _passes(docs, items, window, block_words, finish, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("longest")


#: The contract in SQL: windows as strings, found at every place of every document.
OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
v AS (SELECT item_id, least(len(ws), 13) AS n, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i, ws FROM b WHERE len(ws) > 0),
w AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS g FROM v),
k AS (SELECT DISTINCT n FROM w),
p AS (SELECT doc_id, k.n, ws, unnest(range(1, greatest(len(ws) - k.n + 1, 0) + 1)) AS i FROM d, k),
h AS (SELECT p.doc_id, p.i, p.n, w.item_id FROM p JOIN w ON p.n = w.n AND array_to_string(list_slice(p.ws, p.i, p.i + p.n - 1), ' ') = w.g),
c AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS x FROM h) GROUP BY 1),
s AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(t, ',' ORDER BY t)) AS items_sha256 FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN s USING (doc_id)
"""
