"""Vectorised word and n-gram hashing over the UTF-8 bytes of many texts at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_POLY = U64(0x9E3779B97F4A7C15 | 1)
_GRAM = U64(0xD1342543DE82EF95)


def _class(excluded: bytes) -> np.ndarray:
    mask = np.ones(256, bool)
    mask[list(excluded)] = False
    return mask


#: Bytes of words: all but white space; or digits, a-z and everything beyond ASCII. (A-Z are lowered first.)
NON_SPACE = _class(bytes([0x20, 9, 10, 11, 12, 13]))
ALNUM = _class(bytes(b for b in range(128) if not (0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser. Long arrays go through in pieces that stay in the cache."""
    out = np.array(x, U64)
    flat = out.reshape(-1)
    spare = np.empty(min(len(flat), 1 << 15), U64)
    for at in range(0, len(flat), 1 << 15):
        part = flat[at : at + (1 << 15)]
        moved = spare[: len(part)]
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            np.right_shift(part, U64(shift), out=moved)
            part ^= moved
            if factor > 1:
                part *= U64(factor)
    return out


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _POLY, U64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POW = _powers(4096)


@dataclass
class Words:
    """Words of a slice of texts: byte spans into `data`, hashes, and `first[d]:first[d+1]`, the words of text d."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def docs(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and the offsets of its texts in them."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)


def lowered(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def words_of(column: pa.Array, kind: np.ndarray, lower: bool) -> Words:
    data, offsets = utf8(column)
    if lower:
        data = lowered(data)
    inside = kind[data]
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    edges = offsets[1:-1]
    before[edges[edges < len(data)]] = False
    after[edges[edges > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, offsets, starts, ends, span_hashes(data, starts, ends), np.searchsorted(starts, offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of byte spans, mixed with their lengths."""
    global _POW
    if not len(starts):
        return np.zeros(0, U64)
    lens = ends - starts
    if lens.max() > len(_POW):
        _POW = _powers(int(lens.max()))
    begin = np.zeros(len(lens), np.int64)
    np.cumsum(lens[:-1], out=begin[1:])
    within = np.arange(int(lens.sum())) - np.repeat(begin, lens)
    at = within + np.repeat(starts, lens)
    values = (data[at].astype(U64) + U64(1)) * _POW[within]
    return mix(np.add.reduceat(values, begin) ^ (lens.astype(U64) * _GRAM))


def gram_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rolling hashes of all n-word windows that stay in one text, and the index of each one's first word."""
    h = words.hashes
    if len(h) < n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    size = len(h) - n + 1
    acc = h[:size].copy()
    for j in range(1, n):
        acc *= _GRAM
        acc += h[j : j + size]
    docs = words.docs
    at = np.flatnonzero(docs[:size] == docs[n - 1 : n - 1 + size])
    return mix(acc[at]), at
