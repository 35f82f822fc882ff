"""Secret scans: three patterns, and guess costs of values in a credential context.

Beside the patterns, whatever follows a credential word ("pwd: ...", "passphrase is ...",
"user:value@host") is a candidate. Its guess cost is the cheapest way to spell it as a
chain of listed words, dates, repeats, keyboard walks, unlisted words and brute-force
spans, found by dynamic programming over end positions; each span costs the number of
tries an attacker needs for it, and a chain of n spans costs n! times the product of its spans. Values
whose cost reaches the limit are secrets; "changeme", "qwerty123" or a plain word are not. Whether letters are
a word of some language is judged by their pairs: those of all documents are counted first (:func:`fit_letters`).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.textops import raw_bytes, slices

KINDS = ("assign", "access", "hex", "guess")
BASE_KINDS = KINDS[:3]
MIN_GUESSES_LOG10 = 10.0
MAX_SPAN = 24  # characters of a span, unless it is a repeat or a walk to its end
MAX_UNIT = 12  # characters that such a long repeat repeats

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_CONTEXT = re.compile(
    r"""\b(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|api[ _-]?key)\b["']?"""
    r"""(?:\x20+(?:is|was)\x20+|\x20*(?::|=>?|->)\x20*)["']?([^\s"'<>]{6,})|://[^\s/:@]+:([^\s/@]{6,})@""",
    re.ASCII | re.IGNORECASE,
)

# Words that guessers try first, in the order of their rank.
COMMON_WORDS = tuple(
    """password 123456 qwerty letmein admin welcome monkey dragon master login princess solo sunshine shadow
    iloveyou football baseball superman batman trustno1 secret changeme default example test guest root user
    pass token key value string null none true false your my the placeholder redacted hidden unknown sample
    dummy foo bar hello freedom whatever michael jordan hunter killer ninja mustang access flower cheese computer
    internet summer winter spring autumn january february march april june july august september october november
    december monday friday sunday love money service server system database client public private""".split()
)
# Rows of the keyboard, and the two orders people count in.
WALKS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz", "0123456789")
_RANKS = {w: i + 1 for i, w in enumerate(COMMON_WORDS)}
_NEXT = {(row[i], row[i + 1]) for row in (*WALKS, *(w[::-1] for w in WALKS)) for i in range(len(row) - 1)}
_DATE = re.compile(
    r"(?:(?:19|20)\d\d([-/.]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])"
    r"|(?:0?[1-9]|[12]\d|3[01])([-/.]?)(?:0?[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d)"
)
_UNLISTED_WORD = 5.5  # log10 of the words of a language
_LEET = str.maketrans("013457@$!", "oieastasi")


_LETTERS = 28  # no letter, a to z, and one for all characters beyond ASCII
_CODES = np.zeros(256, dtype=np.int64)
_CODES[[*range(0x61, 0x7B)]] = _CODES[[*range(0x41, 0x5B)]] = range(1, 27)
_CODES[0xC0:] = 27  # first bytes of longer characters


class Letters(NamedTuple):
    """log10 of the tries for each letter after another, and the mean below which letters pass for a word."""

    costs: tuple[tuple[float, ...], ...]
    limit: float

    def is_word(self, word: str) -> bool:
        codes = [ord(c) - 96 if "a" <= c <= "z" else 27 for c in word]
        return sum(self.costs[a][b] for a, b in zip([0, *codes], codes)) <= self.limit * len(codes)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = raw_bytes(part.column("text"))
            kept = (data < 0x80) | (data >= 0xC0)
            codes = _CODES[data[kept]]
            before = np.concatenate(([0], codes[:-1])) if len(codes) else codes
            starts = np.concatenate(([0], np.cumsum(kept)))[offsets[:-1]]
            before[starts[starts < len(codes)]] = 0
            counts = np.bincount(before * _LETTERS + codes, minlength=_LETTERS**2)
            found = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], ["pair", "n"])


def fit_letters(docs: DataFrame, text: str = "text") -> Letters | None:
    """Count the letter pairs of all documents; None if they have no letters. At most 784 sums reach the driver.

    Letters pass for a word if their mean cost lies nearer to that of the documents' own letters than to that of letters
    drawn evenly.
    """
    given = docs.select(F.col(text).cast("string").alias("text")).where("text IS NOT NULL")
    sums = given.mapInArrow(_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(_LETTERS**2)
    counts[[r["pair"] for r in sums]] = [r["n"] for r in sums]
    counts = counts.reshape(_LETTERS, _LETTERS)[:, 1:]
    if not counts.sum():
        return None
    smoothed = counts + 0.5
    costs = -np.log10(smoothed / smoothed.sum(axis=1, keepdims=True))
    own, even = (counts * costs).sum() / counts.sum(), costs[1:27, :26].mean()
    return Letters(tuple((math.inf, *map(float, row)) for row in costs), float(own + even) / 2)


def _brute_force(span: str) -> float:
    kinds = ((26, str.islower), (26, str.isupper), (10, str.isdigit))
    chars = set(span)
    size = sum(n for n, test in kinds if any(test(c) for c in chars))
    size += 33 * any(not c.isalnum() for c in chars) or 0
    return len(span) * math.log10(max(size, 10))


def _span_cost(span: str, letters: Letters | None = None) -> float:
    """log10 of the guesses for one span by its cheapest explanation; without ``letters`` all of them are words."""
    low = span.lower()
    cased = 0.0 if span == low else 0.3 if span == low.capitalize() or span.isupper() else 0.3 * len(span)
    best = _brute_force(span)
    plain = low.translate(_LEET)
    for form, extra in ((low, 0.0), (low[::-1], 0.3), (plain, 0.3)):
        if rank := _RANKS.get(form):
            best = min(best, math.log10(rank) + cased + extra)
    if span.isalpha() and len(span) >= 3 and cased <= 0.3 and (letters is None or letters.is_word(low)):
        best = min(best, _UNLISTED_WORD + cased)
    if len(span) >= 3:
        for unit in range(1, len(span) // 2 + 1):
            if len(span) % unit == 0 and span == span[:unit] * (len(span) // unit):
                best = min(best, min(_brute_force(span[:unit]), _RANKS.get(low[:unit], 1e9)) + math.log10(len(span)))
                break
        if all(pair in _NEXT for pair in zip(low, low[1:])):
            best = min(best, math.log10(50 * len(span)) + cased)
    if len(span) >= 4 and _DATE.fullmatch(span):
        best = min(best, math.log10(100 * (365 if len(span) > 4 else 1)))
    return best


def guesses_log10(value: str, limit: float = math.inf, letters: Letters | None = None) -> float:
    """log10 of the guesses needed for a value: the cheapest segmentation, by dynamic programming; infinite if not below ``limit``.

    ``open_ends[j]`` holds, for each number of spans n that may lead to the cheapest segmentation, the cost of the first j
    characters in n spans; n spans add log10(n!). Costs never fall from left to right, so ends whose cost has reached the
    limit are not followed. The empty value costs 0.
    """
    size = len(value)
    open_ends: dict[int, dict[int, float]] = {0: {0: 0.0}}
    runs = _LongRuns(value)
    while open_ends:
        at = min(open_ends)
        costs = open_ends.pop(at)
        if at == size:
            return min(cost + _log_factorial(n) for n, cost in costs.items())
        least = math.inf
        for n in sorted(costs):  # more spans must be cheaper than fewer
            if costs[n] >= least:
                del costs[n]
            else:
                least = costs[n]
        for end in (*range(at + 1, min(size, at + MAX_SPAN) + 1), *runs.ends(at)):
            span = _span_cost(value[at:end], letters)
            for n, cost in costs.items():
                cost += span
                if cost + _log_factorial(n + 1) < limit:
                    known = open_ends.setdefault(end, {})
                    known[n + 1] = min(cost, known.get(n + 1, math.inf))
    return math.inf


def _log_factorial(n: int) -> float:
    return math.lgamma(n + 1) / math.log(10)


class _LongRuns:
    """Ends of the repeats and keyboard walks of more than MAX_SPAN characters that begin at a place."""

    def __init__(self, value: str) -> None:
        self.value, self.low = value, [c.lower() for c in value]
        self.known = [0] * (MAX_UNIT + 1)  # where the last run found of each unit ends; at 0 that of walks

    def ends(self, at: int) -> set[int]:
        found = set()
        for unit in range(MAX_UNIT + 1):
            end = self.known[unit]
            if end <= at + MAX_SPAN:
                end = self.known[unit] = self._end(at, unit)
            end -= (end - at) % unit if unit else 0
            if end > at + MAX_SPAN:
                found.add(end)
        return found

    def _end(self, at: int, unit: int) -> int:
        end = at + max(unit, 1)
        while end < len(self.value) and (
            self.value[end] == self.value[end - unit] if unit else (self.low[end - 1], self.low[end]) in _NEXT
        ):
            end += 1
        return end


def scan(text: str | None, limit: float = MIN_GUESSES_LOG10, letters: Letters | None = None) -> list[tuple[int, int, str]]:
    """Spans ``start, end, kind`` in code points, by start and then by kind as listed in KINDS."""
    if not text:
        return []
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    if _LONG_HEX.search(text):
        found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text) if len(m[0]) >= 24]
    base = list(found)
    for m in _CONTEXT.finditer(text):
        start, end = m.span(1) if m[1] else m.span(2)
        value = text[start:end].rstrip(".,;:!?)")
        end = start + len(value)
        inside = any(a <= start and end <= b for a, b, _ in base)
        if not inside and len(value) >= 6 and guesses_log10(value, limit, letters) >= limit:
            found.append((start, end, "guess"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


_LONG_HEX = re.compile(r"[0-9a-f]{24}")


def spans_text(spans: Iterable[tuple[int, int, str]]) -> str:
    """``kind:start:end`` of each span, comma-joined."""
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redact(text: str | None, limit: float = MIN_GUESSES_LOG10, letters: Letters | None = None) -> str | None:
    """The text with every secret replaced by its kind in brackets; overlapping spans count as one."""
    if text is None:
        return None
    out, at = [], 0
    for start, end, kind in scan(text, limit, letters):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``secrets`` (array of start, end, kind) and ``redacted`` text.

    Null text has no secrets and stays null. Rows are independent of each other: repeated
    rows, null ids and other columns do not matter. Letter pairs are counted first; nothing else is shuffled.
    """
    letters = fit_letters(docs, text)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows = [[dict(zip(("start", "end", "kind"), s)) for s in scan(t, letters=letters)] for t in texts]
            masked = pa.array([redact(t, letters=letters) if r else t for t, r in zip(texts, rows)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, kind), masked], ["doc_id", "secrets", "redacted"]
            )

    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return given.mapInArrow(
        scanned,
        f"doc_id {given.schema['doc_id'].dataType.simpleString()}, "
        "secrets array<struct<start: int, end: int, kind: string>>, redacted string",
    )


def secret_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts per pattern, a digest of the pattern spans, and all spans as text."""
    letters = fit_letters(docs, text)

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(t, letters=letters) for t in batch.column("text").to_pylist()]
            base = [spans_text(s for s in spans if s[2] in BASE_KINDS) for spans in found]
            columns = [batch.column("doc_id")]
            columns += [pa.array([sum(s[2] == k for s in spans) for spans in found], pa.int64()) for k in BASE_KINDS]
            columns.append(pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()))
            columns.append(pa.array([spans_text(spans) for spans in found], pa.string()))
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
            )

    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return given.mapInArrow(
        digested,
        f"doc_id {given.schema['doc_id'].dataType.simpleString()}, "
        "n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )


def redact_texts(docs: DataFrame, text: str = "text", n_chars: str | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, with secrets in the text replaced; ``n_chars`` names its length, if there is one.

    Null texts stay null and keep their length. Letter pairs are counted first; nothing else is shuffled.
    """
    letters = fit_letters(docs, text)

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before = batch.column(text).to_pylist()
            after = [redact(t, letters=letters) for t in before]
            columns = {name: batch.column(name) for name in batch.schema.names}
            columns[text] = pa.array(after, batch.column(text).type)
            if n_chars in columns:
                sizes = columns[n_chars].to_pylist()
                sizes = [len(b) if a != b else n for a, b, n in zip(before, after, sizes)]
                columns[n_chars] = pa.array(sizes, columns[n_chars].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)

    return docs.mapInArrow(masked, docs.schema)
