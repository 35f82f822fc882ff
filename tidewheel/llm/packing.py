"""Cost-balanced packing of tokenised documents into training sequences.

A document is tokenised once, where it is read. A document longer than a sequence is cut
into full sequences and a rest. Only the lengths and checksums of these pieces travel, and
the ids of one rest in ``filler_every``. Pieces are dealt evenly into groups of some
GROUP_PIECES; within a group the number of sequences follows from the tokens, pieces go in
descending estimated cost, each to the cheapest sequence that still has room for it. The
fillers come last and are cut to close the gaps, so that a group leaves little more
than one sequence partly empty.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.textops import slices
from tidewheel.scratch import materialise

CAPACITY = 2048
END_ID = 1
GROUP_PIECES = 4096
SPECIAL = "<|endoftext|>"
_loaded: dict = {}


def _encoder(ranks_path: str, pattern: str, json_path: str):
    """The vocabulary in two forms: fast ranks, and the full tokenizer for texts that spell a special token."""
    key = (ranks_path, json_path)
    if key not in _loaded:
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        _loaded[key] = fast, Tokenizer.from_file(json_path)
    return _loaded[key]


def token_ids(text: str, ranks_path: str, pattern: str, json_path: str) -> np.ndarray:
    """Ids of one text and the end id, as unsigned 32-bit numbers."""
    fast, full = _encoder(ranks_path, pattern, json_path)
    ids = full.encode(text, add_special_tokens=False).ids if SPECIAL in text else fast.encode_ordinary(text)
    return np.array([*ids, END_ID], dtype="<u4")


def cost(length, linear: float, quadratic: float):
    """Estimated cost of a piece: what grows with its tokens, and attention, which grows with their square."""
    return linear * length + quadratic * np.square(length, dtype=np.float64)


def assign(
    lengths: np.ndarray, filler: np.ndarray, capacity: int, linear: float, quadratic: float
) -> list[tuple[int, int, int, int, int]]:
    """Place the pieces of one group: ``piece, from, length, sequence, offset`` of every part.

    There are as many sequences as the tokens fill. Whole pieces go in descending cost, each
    to the cheapest sequence with room for it; equal costs go by position. Fillers come
    last: they are cut at will, so that they close the gaps. Whole pieces that
    found no room get further sequences by the same rule.
    """
    costs = cost(lengths, linear, quadratic)
    waiting = [int(p) for p in np.argsort(-costs, kind="stable") if not filler[p]]
    total, opened, parts = int(lengths.sum()), 0, []
    closing = [int(p) for p in np.flatnonzero(filler)]
    while waiting or closing:
        bins = -(-total // capacity)
        used, load, late = np.zeros(bins, dtype=np.int64), np.zeros(bins), []
        for piece in waiting:
            size = int(lengths[piece])
            best = int(np.argmin(np.where(used + size <= capacity, load, np.inf)))
            if used[best] + size > capacity:
                late.append(piece)
                continue
            parts.append((piece, 0, size, opened + best, int(used[best])))
            used[best] += size
            load[best] += costs[piece]
        left = []
        for piece in closing:
            at, size = 0, int(lengths[piece])
            while at < size and (used < capacity).any():
                best = int(np.argmin(np.where(used < capacity, load, np.inf)))
                part = min(size - at, capacity - int(used[best]))
                parts.append((piece, at, part, opened + best, int(used[best])))
                used[best] += part
                load[best] += cost(part, linear, quadratic)
                at += part
            if at < size:
                left.append((piece, at, size))
        # Fillers can only be left over if whole pieces were late; they follow in a sequence of their own.
        opened += bins
        for piece, at, size in left:
            parts.append((piece, at, size - at, opened, 0))
            opened += 1
        waiting, closing, total = late, [], int(lengths[late].sum()) if late else 0
    return parts


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    linear: float = 1.0,
    quadratic: float = 1 / 512,
    group_pieces: int = GROUP_PIECES,
    filler_every: int = 24,
    vocabulary: str = "byte_bpe_50k",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, cost``.

    ``vocabulary`` names a byte-level BPE of the installed public tokenizers. Null text is empty text:
    a document of the end id alone. Every row is packed, also repeated rows and rows with
    a null id. Equal costs go in the order in which the documents were read. Ids are not returned; the checksum of each piece proves which they are. Runs one job that stores the
    pieces.
    """
    import public_tokenizers as public

    files = public.path(f"{vocabulary}.tiktoken"), public.PATTERN, public.path(f"{vocabulary}.json")
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    id_type = given.schema["doc_id"].dataType.simpleString()

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "filler"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rests = 0
        for batch in batches:
            for part in slices(batch, "text"):
                rows: list[tuple] = []
                for i, value in enumerate(part.column("text").to_pylist()):
                    ids = token_ids(value or "", *files)
                    for start in range(0, len(ids), capacity):
                        piece = ids[start : start + capacity].tobytes()
                        rests += len(piece) < 4 * capacity
                        filler = len(piece) < 4 * capacity and rests % filler_every == 0
                        rows.append(
                            (i, start, len(piece) // 4, zlib.crc32(piece), len(ids), piece if filler else None)
                        )
                at, *numbers, kept = zip(*rows, strict=True)
                columns = [part.column("doc_id").take(pa.array(at, pa.int64()))]
                columns += [pa.array(c, pa.int64()) for c in numbers] + [pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)

    shape = f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long"
    cut = given.mapInArrow(pieces, f"{shape}, filler binary").withColumn("piece", F.monotonically_increasing_id())
    cut = materialise(cut, "pieces")
    groups = max(1, -(-cut.count() // group_pieces))

    def placed(table: pa.Table) -> pa.Table:
        table = table.sort_by("piece")
        lengths, starts = table.column("length").to_numpy(), table.column("start").to_numpy()
        kept, crcs = table.column("filler").to_pylist(), table.column("ids_crc32").to_numpy()
        filler = np.array([k is not None for k in kept])
        parts = assign(lengths, filler, capacity, linear, quadratic)
        piece, at, size, sequence, offset = (np.array(c, dtype=np.int64) for c in zip(*parts, strict=True))
        sums = [zlib.crc32(kept[p][4 * a : 4 * (a + n)]) if filler[p] else crcs[p] for p, a, n, _, _ in parts]
        base = table.column("pack_group")[0].as_py() << 32
        return pa.table(
            {
                "doc_id": table.column("doc_id").take(pa.array(piece)),
                "start": starts[piece] + at,
                "length": size,
                "ids_crc32": pa.array(sums, pa.int64()),
                "doc_tokens": table.column("doc_tokens").take(pa.array(piece)),
                "sequence_id": sequence + base,
                "offset": offset,
                "cost": cost(size, linear, quadratic),
            }
        )

    dealt = F.pmod(F.xxhash64("piece"), F.lit(groups))  # even, however many rows are alike
    return (
        cut.withColumn("pack_group", dealt)
        .groupBy("pack_group")
        .applyInArrow(placed, f"{shape}, sequence_id long, offset long, cost double")
    )
