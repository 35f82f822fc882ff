"""Vectorised text work inside Spark tasks: Arrow strings in, numpy arrays out.

Texts arrive as Arrow batches. A batch is cut into slices of whole documents with
bounded bytes, so memory follows the slice (or one very long document), never the
partition. Word hashes are 64-bit and depend on the word's bytes only.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_rng = np.random.default_rng(0x5EED)
_BYTE_KEYS = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C1B  # congruent to 3 modulo 8: powers stay apart in the low bits
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


class Words(NamedTuple):
    """Words of several documents: ``first[d]:first[d + 1]`` are those of document d."""

    data: np.ndarray  # bytes of all texts
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    offsets: np.ndarray  # where each text starts in data

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        known[0] = 1
        known = _powers[base] = np.cumprod(known, dtype=np.uint64)
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, text: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of whole rows with at most ``max_bytes`` of text (or one row)."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(size, dtype=np.int64)
    at = 0
    while at < len(total):
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + max_bytes, side="right")))
        yield batch.slice(at, end - at)
        at = end


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and the n + 1 offsets of each; null counts as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, dtype=np.uint8), at - at[0]
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """Lower-case A-Z and nothing else."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def split_words(texts: pa.Array, lower: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text; none in null or empty ones."""
    data, offsets = raw_bytes(texts)
    if lower:
        data = lower_ascii(data)
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside))
    after = np.concatenate((inside, [False]))
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return Words(data, starts, ends, np.searchsorted(starts, offsets), offsets)


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, from differences of one running polynomial."""
    if not len(words.starts):
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(words.data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_KEYS[words.data] * powers(_BASE, len(words.data)), out=total[1:])
    length = (words.ends - words.starts).astype(np.uint64)
    return mix((total[words.ends] - total[words.starts]) * powers(_INVERSE, len(words.data))[words.starts] + length)


def window_hashes(hashes: np.ndarray, at: np.ndarray, size: int, base: int = _BASE) -> np.ndarray:
    """Hash of the ``size`` word hashes from each place in ``at``; windows must not leave their document."""
    out = np.zeros(len(at), dtype=np.uint64)
    for k, factor in enumerate(powers(base, size)):
        out += hashes[at + k] * factor
    return mix(out)
