"""Removal of long passages that repeat an earlier document, found by difference-cover anchors.

Hashing every window of a corpus costs as much as the corpus. Here only windows at cover
positions are hashed at first: places p with ``p % period`` in a difference cover. For any two
documents that share a passage, whatever its two offsets are, some d below the period puts
both offset + d on the cover; the passage therefore holds an anchor of ``window - period + 1``
words that both documents hash. Anchors seen in one document only rule out all windows around
them. Around shared anchors each match is extended: every full window holding one is hashed, and the
smallest document of each window decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.joins import BROADCAST_IDS, discard, keep_ids, store, stored_ids
from tidewheel.llm.textops import Words, mix, slices, split_words, window_hashes, word_hashes

# Perfect difference sets; every difference modulo the period occurs.
COVERS = {
    1: (0,),
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
}
_SECOND_BASE = 0xD1B54A32D192ED03


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The widest period that leaves anchors of at least three eighths of the window."""
    period = max(p for p in COVERS if 8 * p <= 5 * window + 3)
    return period, COVERS[period]


def _places(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: its document in the slice, its place there, and how many words are left from it on."""
    count = words.counts
    doc = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(words.starts)) - np.repeat(words.first[:-1], count)
    return doc, place, np.repeat(count, count) - place


def _anchors(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, index of the first word, and hash of every anchor of a slice."""
    period, cover = cover_for(window)
    size = window - period + 1
    doc, place, left = _places(words)
    on = np.zeros(period, dtype=bool)
    on[list(cover)] = True
    at = np.flatnonzero(on[place % period] & (left >= size))
    return doc[at], at, window_hashes(word_hashes(words), at, size)


def _anchor_rows(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            doc, _, anchor = _anchors(split_words(part.column("text")), window)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), part.column("doc_id").take(pa.array(doc))], ["anchor", "doc_id"]
            )


def _window_rows(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of all full windows that hold a shared anchor."""
    period, _ = cover_for(window)
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            words = split_words(part.column("text"))
            doc, at, anchor = _anchors(words, window)
            shared = part.column("anchors")
            bounds = np.searchsorted(doc, np.arange(part.num_rows + 1))
            reach = np.zeros(len(words.starts) + 1, dtype=np.int64)
            for d in range(part.num_rows):
                mine = slice(bounds[d], bounds[d + 1])
                known = np.array(shared[d].as_py() or [], dtype=np.int64).view(np.uint64)
                p = at[mine][np.isin(anchor[mine], known)]
                np.add.at(reach, np.maximum(p - period + 1, words.first[d]), 1)
                np.add.at(reach, p + 1, -1)
            of, place, left = _places(words)
            start = np.flatnonzero((np.cumsum(reach)[:-1] > 0) & (left >= window))
            hashes = word_hashes(words)
            first = window_hashes(hashes, start, window)
            second = window_hashes(mix(hashes + np.uint64(1)), start, window, _SECOND_BASE)
            of = pa.array(of[start])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(first.view(np.int64)),
                    pa.array((second >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                    part.column("doc_id").take(of),
                    part.column("row").take(of),
                    pa.array(place[start].astype(np.int32)),
                ],
                ["h1", "h2", "doc_id", "row", "start"],
            )


def _cleaned(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of words, number removed, and the kept words, given the starts of repeated windows."""
    for batch in batches:
        for part in slices(batch, "text"):
            words = split_words(part.column("text"))
            n_words, removed, texts = words.counts, [], []
            data = words.data.tobytes()
            for d in range(part.num_rows):
                a, b = int(words.first[d]), int(words.first[d + 1])
                gone = np.zeros(b - a + 1, dtype=np.int64)
                starts = np.array(part.column("starts")[d].as_py() or [], dtype=np.int64)
                np.add.at(gone, starts, 1)
                np.add.at(gone, starts + window, -1)
                kept = np.flatnonzero(np.cumsum(gone)[:-1] == 0) + a
                removed.append(b - a - len(kept))
                texts.append(b" ".join(data[s:e] for s, e in zip(words.starts[kept], words.ends[kept])).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(n_words.astype(np.int64)),
                    pa.array(removed, pa.int64()),
                    pa.array(texts, pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept"],
            )


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 50) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept`` (the words left, joined by one blank).

    A word ``[^\\x20\\x09-\\x0D]+`` is removed if it lies in a run of ``window`` words that also
    occurs in a document with a smaller id. Windows are judged on the input. Null and blank
    texts have no words and are kept as empty text. A document with a null id neither
    loses words nor takes them from others; rows repeating an id do not take from each other.
    Matches rest on 96-bit hashes. Other columns are not read. Runs jobs while it builds the result.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    known = docs.where("doc_id IS NOT NULL")
    anchors = store(known.mapInArrow(partial(_anchor_rows, window), "anchor long, doc_id long"), "anchors")
    groups = anchors.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    groups = store(groups.where("low < high").select("anchor"), "anchor-groups")
    shared = store(anchors.join(groups, "anchor"), "shared-anchors")
    discard(anchors)
    ids = stored_ids(shared, "doc_id")
    few = ids.count() <= BROADCAST_IDS
    # Texts that share an anchor are stored once with a row number; all others keep every word.
    texts = store(keep_ids(known, ids, "doc_id").withColumn("row", F.monotonically_increasing_id()), "shared-texts")
    lists = shared.groupBy("doc_id").agg(F.collect_list("anchor").alias("anchors"))
    windows = texts.join(lists, "doc_id").mapInArrow(
        partial(_window_rows, window), "h1 long, h2 int, doc_id long, row long, start int"
    )
    # Groups are stored before they are joined, so that the join's shuffles are its own and a hot window can be split.
    first = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    first = store(first.where("first < last").drop("last"), "window-groups")
    repeated = store(
        windows.join(first, ["h1", "h2"])
        .where("doc_id > first")
        .groupBy("row")
        .agg(F.collect_list("start").alias("starts")),
        "repeats",
    )
    shape = "doc_id long, n_words long, n_removed long, kept string"
    touched = texts.join(repeated, "row", "left").select("doc_id", "text", "starts")
    others = docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_anti")
    others = others.withColumn("starts", F.lit(None).cast("array<int>"))
    return touched.unionByName(others).mapInArrow(partial(_cleaned, window), shape)


def repeat_digests(docs: DataFrame) -> DataFrame:
    """The removal of 50-word repeats with the kept text as a digest, made where the text is."""
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
