"""What an announcement's text says of days and hours, found by walking over a line's tokens.

A token is a number, a run of letters or one sign. Each reader below starts at a place in a line and gives what it read
and the place after it, or None; a scan takes the first reader that fits and goes on behind it. Nothing reads across lines.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heraldo.functions import resolve

# Names of months, what joins two ends of a span, and words that end, bound or price something.
MONTHS = {name: i for names in (resolve.MONTHS, resolve.SHORT_MONTHS) for i, name in enumerate(names, 1)} | resolve.OTHER_MONTHS
DASHES = {"-", "–", "—"}
DAY_JOINTS, MONTH_FIRST_JOINTS, HOUR_JOINTS = DASHES | {"al", "a", "hasta", "y", "&"}, DASHES | {"al", "a", "&"}, DASHES | {"a", "hasta"}
ENDING_AT, BOUNDS = {"cerramos", "cierra", "termina", "terminamos", "finaliza"}, {"antes", "despues"}
PARTS_OF_DAY = {"noche", "tarde", "manana"}
PRICE_WORDS = set("cover valor precio costo boleta boletas tiquete tiquetes inversion aporte bono donacion etapa boleteria taquilla preventa consumible cop".split())

_TOKEN = re.compile(r"\d+|[^\W\d_]+|\S")
LAST_MINUTE = ":59"
# words that any reader begins with, beside numbers
OPENERS = {"primero", "mediodia", "medianoche"} | set(MONTHS)
KNOWN_TEXTS, KNOWN_CHARS = 1 << 14, 500


class Token(NamedTuple):
    text: str
    begin: int
    end: int


class Line:
    """The tokens of one line, folded."""

    def __init__(self, line: str):
        folded = "".join(c for c in unicodedata.normalize("NFKD", line).casefold() if not unicodedata.combining(c))
        self.tokens = [Token(m[0], m.start(), m.end()) for m in _TOKEN.finditer(folded)]
        self.openings = [i for i, t in enumerate(self.tokens) if t.text[0].isdecimal() or t.text in OPENERS]

    def __len__(self) -> int:
        return len(self.tokens)

    def at(self, i: int) -> str:
        return self.tokens[i].text if 0 <= i < len(self.tokens) else ""

    def glued(self, i: int) -> bool:
        """Whether the token at i touches the one before."""
        return 0 < i < len(self.tokens) and self.tokens[i].begin == self.tokens[i - 1].end

    def number(self, i: int, least: int, most: int, digits: tuple[int, ...] = (1, 2)) -> int | None:
        text = self.at(i)
        return int(text) if text.isascii() and text.isdigit() and len(text) in digits and least <= int(text) <= most else None

    def day(self, i: int) -> int | None:
        """A day of a month: no piece of an address, of a fraction or of a clock time."""
        return None if self.glued(i) and self.at(i - 1) in ("#", "/", ":") else self.number(i, 1, 31)

    def month(self, i: int) -> tuple[int, int] | None:
        """A month's name, with or without "de" before it, also where the two run together."""
        if self.at(i) == "de" and self.at(i + 1) in MONTHS:
            return MONTHS[self.at(i + 1)], i + 2
        name = self.at(i) if self.at(i) in MONTHS else self.at(i).removeprefix("de")
        return (MONTHS[name], i + 1) if name in MONTHS else None

    def leading_month(self, i: int) -> tuple[int, int] | None:
        """A month's name before its day; "mar" is a Tuesday there."""
        name = self.at(i)
        return (MONTHS[name], i + 1 + (self.at(i + 1) == ".")) if name in MONTHS and name != "mar" else None


def read_date(line: Line, i: int) -> tuple[tuple[int, int], int] | None:
    """((day, month), next) of one date in words or in numbers."""
    if line.at(i) == "primero" and (month := line.month(i + 1)):
        return (1, month[0]), month[1]
    if (month := line.leading_month(i)) and (day := line.day(month[1])):
        return (day, month[0]), month[1] + 1
    day = line.day(i)
    if not day:
        return None
    if month := line.month(i + 1 + (line.glued(i + 1) and line.at(i + 1) in ("ro", "o", "°"))):
        return (day, month[0]), month[1]
    sign, joined = line.at(i + 1), all(map(line.glued, (i + 1, i + 2)))
    number = line.number(i + 2, 1, 12)
    if not joined or not number:
        return None
    year = line.glued(i + 3) and line.at(i + 3) == sign and line.glued(i + 4) and len(line.at(i + 4)) in (2, 4) and line.number(i + 4, 0, 2099, (2, 4)) is not None
    after = i + 5 if year else i + 3
    if sign == "/" and line.at(i) + line.at(i + 2) != "247" and not (line.glued(after) and line.at(after) == "/"):
        return (day, number), after
    return ((day, number), after) if sign in (".", "-") and year else None


def read_range(line: Line, i: int) -> tuple[tuple[int, int], int] | None:
    """((last day, month), next) of a range of days. Two days joined by "y" or "&" are one if they follow each other."""
    if month := line.leading_month(i):
        first, joint, last = line.day(month[1]), line.at(month[1] + 1), line.day(month[1] + 2)
        clock = line.glued(month[1] + 3) and line.at(month[1] + 3) == ":"
        if first and last and joint in MONTH_FIRST_JOINTS and not clock and (joint != "&" or last == first + 1):
            return (last, month[0]), month[1] + 3
        return None
    first, j = line.day(i), i + 1
    if not first:
        return None
    if own := line.month(j):
        j = own[1] + (line.at(own[1]) == ".")
    joint = line.at(j)
    j += 1 + (line.at(j + 1) == "el")
    last = line.day(j)
    month = line.month(j + 1) if last else None
    return ((last, month[0]), month[1]) if month and joint in DAY_JOINTS and (joint not in ("y", "&") or last == first + 1) else None


def read_list(line: Line, i: int) -> tuple[tuple[list[int], int], int] | None:
    """((days, month), next) of several days with one month."""
    days, j = [line.day(i)], i + 1
    while line.at(j) in (",", "·") and line.day(j + 1):
        days.append(line.day(j + 1))
        j += 2
    comma = j + (line.at(j) == ",")
    if line.at(comma) == "y" and (len(days) > 1 or line.at(comma + 1) == "el"):
        last = comma + 1 + (line.at(comma + 1) == "el")
        if line.day(last):
            days.append(line.day(last))
            j = last + 1
    month = line.month(j)
    return ((days, month[0]), month[1]) if days[0] and len(days) > 1 and month else None


def read_half(line: Line, i: int) -> tuple[str, int] | None:
    """The half of the day that an hour is in (am, pm, m for noon, night), and the place after it."""
    text = line.at(i)
    if text == "de" and line.at(i + 1) == "la" and line.at(i + 2) in PARTS_OF_DAY:
        return {"manana": "am", "tarde": "pm", "noche": "night"}[line.at(i + 2)], i + 3
    if text in ("a", "p"):
        j = i + 1 + (line.at(i + 1) == ".")
        return (text + "m", j + 1 + (line.at(j + 1) == ".")) if line.at(j) == "m" else None
    return (text, i + 1 + (line.at(i + 1) == ".")) if text in ("am", "pm", "m") else None


def clock(hour: int, minutes: int, half: str | None) -> str | None:
    """HH:MM of 24 hours; None for an hour that no day has."""
    if hour == 12 and half in ("am", "night"):
        hour = 0
    elif hour < 12 and half in ("pm", "night"):
        hour += 12
    return f"{hour:02d}:{minutes:02d}" if hour < 24 else None


def _hour(line: Line, i: int) -> tuple[int, int | None, int] | None:
    """An hour with its minutes, if any, and the place after them."""
    hour = None if line.glued(i) and line.at(i - 1) in (":", "/") else line.number(i, 0, 99)
    if hour is None:
        return None
    minutes = line.number(i + 2, 0, 59, (2,)) if line.glued(i + 1) and line.at(i + 1) == ":" and line.glued(i + 2) else None
    return hour, minutes, i + 1 if minutes is None else i + 3


def read_time(line: Line, i: int) -> tuple[str | None, int] | None:
    """(HH:MM, next) of one clock time."""
    if line.at(i) in ("mediodia", "medianoche"):
        return ("12:00" if line.at(i) == "mediodia" else "00:00"), i + 1
    found = _hour(line, i)
    if not found:
        return None
    hour, minutes, j = found
    if half := read_half(line, j):
        return clock(hour, minutes or 0, half[0]), half[1]
    if minutes is not None:
        return clock(hour, minutes, None), j
    if line.glued(j) and line.at(j) == "h":
        after = line.number(j + 1, 0, 59, (2,)) if line.glued(j + 1) else None
        if after is not None:
            return clock(hour, after, None), j + 2
        if 10 <= hour <= 23 and not (line.glued(j + 1) and line.at(j + 1).isalnum()):  # under ten it's a duration
            return clock(hour, 0, None), j + 1
    return None


def read_span(line: Line, i: int) -> tuple[tuple[str | None, str | None], int] | None:
    """((start, end), next) of a span of time. A start without its half takes the end's, or the evening's if the span
    ends after midnight; one later than its end stands as printed."""
    first = _hour(line, i)
    half = first and read_half(line, first[2])
    j = half[1] if half else first[2] if first else i
    if not first or line.at(j) not in HOUR_JOINTS:
        return None
    last = _hour(line, j + 1 + (line.at(j + 1) == "las"))
    end = last and read_half(line, last[2])
    if not last or not end:
        return None
    own = half[0] if half else "pm" if end[0] == "am" and first[0] > last[0] else end[0] if first[0] <= last[0] else None
    return (clock(first[0], first[1] or 0, own), clock(last[0], last[1] or 0, end[0])), end[1]


def _bounded(line: Line, i: int) -> bool:
    """Whether the words before place i make the time there an end or a bound."""
    j = i - 1 - (line.at(i - 1) in ("la", "las"))
    return line.at(j) == "hasta" or (line.at(j) == "de" and line.at(j - 1) in BOUNDS) or (line.at(j) == "a" and line.at(j - 1) in ENDING_AT)


def _sells(line: Line, i: int, end: int) -> bool:
    """Whether what stands between i and end is when a price holds or a term ends, and not an event's days."""
    bars = [k for k in range(len(line)) if line.at(k) == "|"]
    low, high = max([k + 1 for k in bars if k < i], default=0), min([k for k in bars if k >= end], default=len(line))
    for k in range(low, high):
        thousands = line.number(k, 0, 999, (1, 2, 3)) is not None and line.at(k + 1) == "." and line.glued(k + 1) and line.glued(k + 2) and len(line.at(k + 2)) == 3 and line.at(k + 2).isdigit()
        if line.at(k) == "$" or line.at(k) in PRICE_WORDS or thousands or (line.at(k).isdigit() and line.at(k + 1) in ("k", "mil")):
            return True
    letters = lambda a, b: [line.at(k) for k in range(a, b) if line.at(k).isalpha()]
    before, after = letters(0, i)[-3:], letters(end, len(line))[:4]
    ending = set(resolve.DEADLINE_WORDS)
    said = [line.at(k) for k in range(len(line))]
    if any(a in resolve.CLOSING_NIGHTS and b == "de" and c == "cierre" for a, b, c in zip(said, said[1:], said[2:])):
        ending.discard("cierre")
    return "hasta" in before[-2:] or "antes" in before or bool(ending & {*before, *after})


def _found(line: Line, reader) -> list[tuple[int, int, object]]:
    """(begin, end, what was read) of all that a reader finds, none overlapping."""
    out, free = [], 0
    for i in line.openings:
        if i >= free and (hit := reader(line, i)):
            out.append((i, hit[1], hit[0]))
            free = max(hit[1], i + 1)
    return out


def scan(caption: str) -> dict[str, list]:
    """Dates, ranges' last days, lists, start times and all times of a text; ranges that price something are left out."""
    lines = [Line(x) for x in caption.splitlines()]
    spans = [x for line in lines for _, _, x in _found(line, read_span)]
    starts, ends = {s for s, _ in spans if s}, {e for _, e in spans if e}
    every = starts | ends
    for line in lines:
        for i, _, value in _found(line, read_time):
            if value is None or value.endswith(LAST_MINUTE):
                continue
            every.add(value)
            if _bounded(line, i):
                ends.add(value)
            elif value not in ends:
                starts.add(value)
    pair = lambda x: {"day": x[0], "month": x[1]}
    return {
        "dates": [pair(x) for line in lines for _, _, x in _found(line, read_date)],
        "ranges": [pair(x) for line in lines for i, j, x in _found(line, read_range) if not _sells(line, i, j)],
        "lists": [{"days": x[0], "month": x[1]} for line in lines for _, _, x in _found(line, read_list)],
        "starts": sorted(starts), "times": sorted(every),
    }


_DAY = T.StructType().add("day", T.IntegerType()).add("month", T.IntegerType())
_LIST = T.StructType().add("days", T.ArrayType(T.IntegerType())).add("month", T.IntegerType())
MENTIONS = T.StructType().add("dates", T.ArrayType(_DAY)).add("ranges", T.ArrayType(_DAY)).add("lists", T.ArrayType(_LIST)).add("starts", T.ArrayType(T.StringType())).add("times", T.ArrayType(T.StringType()))
_ARROW_DAY = pa.struct([("day", pa.int32()), ("month", pa.int32())])
_ARROW = pa.struct([("dates", pa.list_(_ARROW_DAY)), ("ranges", pa.list_(_ARROW_DAY)), ("lists", pa.list_(pa.struct([("days", pa.list_(pa.int32())), ("month", pa.int32())]))), ("starts", pa.list_(pa.string())), ("times", pa.list_(pa.string()))])


@functools.lru_cache(KNOWN_TEXTS)
def known_scan(caption: str) -> dict[str, list]:
    return scan(caption)


@F.arrow_udf(MENTIONS)
def mentions(caption: pa.Array) -> pa.Array:
    """struct(dates, ranges, lists, starts, times) of each text; a null text names nothing. Equal texts are read once a batch,
    short ones once while a task's worker holds them."""
    coded = caption.dictionary_encode("encode")
    texts = ["" if x is None else x for x in coded.dictionary.to_pylist()]
    return pa.array([(known_scan if len(x) <= KNOWN_CHARS else scan)(x) for x in texts], _ARROW).take(coded.indices)
