"""Secret scan with structural confirmation.

Base matches are assignments to names like password, access key ids and long hex runs. Beside them, base64 and hex
candidates are decoded and reported only if what they hold is built like a secret: DER private keys whose nested lengths
fit exactly, OpenSSH keys with fitting string lengths, PEM blocks around either, and signed tokens whose header and
payload are JSON objects with an algorithm named. Spans are code points, end exclusive.

An Arrow regular expression first tells which texts can hold anything at all; only those are searched in Python.

Defined cases: null and empty texts have no spans; overlapping spans of different kinds are all reported; rows are
scanned one by one, so repeated rows get equal results; an empty table gives no rows; a text is scanned in time in
proportion to its length, however long; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

KINDS = ["assign", "access", "hex", "pem", "der", "openssh", "jwt"]
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
MAY_HOLD = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}|[0-9A-Fa-f]{48}|[A-Za-z0-9+/_-]{40}|eyJ[A-Za-z0-9_-]+\.|-----BEGIN"""
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS, _HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]{24,}")
_PEM = re.compile(r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----([A-Za-z0-9+/=\s]+?)-----END [A-Z ]*PRIVATE KEY-----", re.ASCII)
_BASE64, _LONG_HEX = re.compile(r"[A-Za-z0-9+/_-]{40,}+={0,2}"), re.compile(r"[0-9A-Fa-f]{48,}+")
#: The same over lines of 40 characters or more and, maybe, a shorter last one.
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/])((?:[A-Za-z0-9+/]{40,}+={0,2}\r?\n)++)([A-Za-z0-9+/]++={0,2})?+")
#: Where a token begins, so that no long run is tried from within.
_JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]++)\.([A-Za-z0-9_-]++)\.([A-Za-z0-9_-]*+)")


def decode_base64(text: str) -> bytes | None:
    """The bytes of standard or URL-safe base64, padded or not; null if it is neither."""
    plain = re.sub(r"\s", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """The DER elements (tag, content) that make up data exactly; null if lengths don't fit."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            size, at = int.from_bytes(data[at : at + n], "big"), at + n
        if at + size > len(data):
            return None
        out.append((tag, data[at : at + size]))
        at += size
    return out


def is_der_key(data: bytes) -> bool:
    """Whether data is a private key: PKCS#1, SEC 1, or PKCS#8, plain or encrypted."""
    outer = _elements(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    parts = _elements(outer[0][1])
    if not parts:
        return False
    tags = [t for t, _ in parts]
    algorithm = lambda i: parts[i][0] == 0x30 and (inner := _elements(parts[i][1])) and inner[0][0] == 6
    if len(tags) >= 9 and set(tags[:9]) == {2}:
        return parts[0][1] in (b"\0", b"\1")
    if tags[:2] == [2, 4] and parts[0][1] == b"\1":
        return len(parts[1][1]) >= 16
    if len(tags) >= 3 and tags[0] == 2 and tags[2] == 4 and parts[0][1] in (b"\0", b"\1"):
        return bool(algorithm(1))
    return len(tags) == 2 and tags[1] == 4 and bool(algorithm(0))


def is_openssh_key(data: bytes) -> bool:
    """Whether data is an OpenSSH key: cipher, key derivation and its options, public keys, private ones, and no more."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)

    def strings(n: int) -> bool:
        nonlocal at
        for _ in range(n):
            if at + 4 > len(data):
                return False
            at += 4 + int.from_bytes(data[at : at + 4], "big")
        return at <= len(data)

    if not strings(3) or at + 4 > len(data):
        return False
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    return 1 <= keys <= 16 and strings(keys) and at + 4 < len(data) and strings(1) and at == len(data)


def _json_object(text: str) -> dict | None:
    data = decode_base64(text)
    try:
        found = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def _key_kind(data: bytes | None) -> str | None:
    if data and len(data) >= 24:
        return "der" if is_der_key(data) else "openssh" if is_openssh_key(data) else None
    return None


def _key_starts(run: str) -> Iterator[int]:
    """Where in a base64 run a key may begin: at its start, and after a slash if the DER length there fits the rest."""
    yield 0
    plain = run.rstrip("=")
    for m in re.finditer("/(?=M)", plain):
        head = decode_base64(plain[m.end() : m.end() + 8])
        if head and len(head) == 6 and head[0] == 0x30:
            n = head[1] & 0x7F if head[1] >= 0x80 else 0
            size = int.from_bytes(head[2 : 2 + n], "big") if n else head[1]
            if n <= 4 and 2 + n + size == (len(plain) - m.end()) * 3 // 4:
                yield m.end()


def scan(text: str) -> list[tuple[int, int, int]]:
    """Spans (start, number of the kind in KINDS, end), in order."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    found += [(m.start(), 3, m.end()) for m in _PEM.finditer(text) if _key_kind(decode_base64(m[2]))]
    for m in _BASE64.finditer(text):
        for at in _key_starts(m[0]):
            if kind := _key_kind(decode_base64(m[0][at:])):
                found.append((m.start() + at, KINDS.index(kind), m.end()))
                break
    for m in _WRAPPED.finditer(text):
        for lines in (m[0], m[1].rstrip()):  # what follows the last whole line may be prose
            if "\n" in lines and (kind := _key_kind(decode_base64(lines))):
                found.append((m.start(), KINDS.index(kind), m.start() + len(lines)))
                break
    for m in _LONG_HEX.finditer(text):
        if len(m[0]) % 2 == 0 and (kind := _key_kind(bytes.fromhex(m[0]))):
            found.append((m.start(), KINDS.index(kind), m.end()))
    for m in _JWT.finditer(text):
        header = _json_object(m[1])
        if header and isinstance(header.get("alg"), str) and _json_object(m[2]) is not None:
            found.append((m.start(), 6, m.end()))
    return sorted(set(found))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            likely = pc.fill_null(pc.match_substring_regex(part.column("text"), MAY_HOLD), False)
            spans = [[]] * part.num_rows
            for i, text in zip(pc.indices_nonzero(likely).to_pylist(), part.column("text").filter(likely).to_pylist()):
                spans[i] = scan(text)
            counts = [pa.array([sum(s[1] == k for s in x) for x in spans], pa.int64()) for k in range(3)]
            digests = [hashlib.sha256(_joined([s for s in x if s[1] < 3]).encode()).hexdigest() for x in spans]
            yield pa.record_batch([part.column("doc_id"), *counts, pa.array(digests, pa.string()), pa.array(map(_joined, spans), pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def find_secrets(docs: DataFrame) -> DataFrame:
    """Counts, digest and spans of SCHEMA for every row of (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scan_batches, SCHEMA)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))
