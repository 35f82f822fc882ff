"""Katz backoff language model of word pairs, trained and applied on the cluster.

A token is a word of the text with A-Z lower-cased, or the one end that closes each text; the
history of a text's first token is the end as well. Counts of up to GT_MAX are discounted by
Good-Turing; what a history's discounts free is dealt to the words that never followed
it, in proportion to the single-word model, by a weight that makes the probabilities of every history sum
to one over the known words and one class of unknown words.

How it runs. Documents are dealt into chunks by a hash, so that a chunk's distinct words, not its tokens, are
counted and looked up. Words get numbers in the order of falling counts: the number tells
the count by a table with one row for each different count (at most the root of twice the tokens).
Documents are stored as numbers. A run of some documents sends each of its distinct pairs once, in packed arrays, to
a bucket by the hash of the whole pair, so that a frequent history is spread over all buckets, and gets the counts back.
Every bucket adds its share to the sums of its histories, which go to buckets of histories; from there a run gets
the weights of its distinct histories. A chunk then scores its documents by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewheel.llm.joins import discard, store
from tidewheel.llm.textops import mix, slices, split_words, word_hashes

GT_MAX = 5
CHUNK_BYTES = 8 << 20
CHUNKS_PER_BUCKET = 8
BUCKET_TOKENS = 4_000_000
TABLE_PAIRS = 1 << 20  # in one row of a count table
UNKNOWN, END = 0xFFFFFFFF, 0xFFFFFFFE  # numbers that no word has


@dataclass
class Words:
    """The single-word model: numbers from ``first[i]`` on have count ``count[i]`` and log10 probability ``log[i]``.

    The end has a number, count and probability of its own.
    """

    first: np.ndarray
    count: np.ndarray
    log: np.ndarray
    end_count: int
    end_log: float
    unknown_log: float
    tokens: int
    size: int

    def counts(self, ids: np.ndarray) -> np.ndarray:
        return self._look_up(self.count, ids, 0, self.end_count)

    def logs(self, ids: np.ndarray) -> np.ndarray:
        return self._look_up(self.log, ids, self.unknown_log, self.end_log)

    def _look_up(self, values: np.ndarray, ids: np.ndarray, unknown, end):
        special = np.where(ids == END, end, unknown)
        if not len(values):
            return special
        at = np.searchsorted(self.first, ids, side="right") - 1
        return np.where(ids >= END, special, values[at])


def discounts(count_of_counts: dict[int, int], top: int = GT_MAX) -> np.ndarray:
    """Factors for counts 0..top (index 0 unused) by Good-Turing, renormalised so that larger counts stay whole.

    A factor that the counts of counts do not give, or not between 0 and 1, is 1.
    """
    n = [count_of_counts.get(r, 0) for r in range(top + 2)]
    out = np.ones(top + 1)
    beyond = (top + 1) * n[top + 1] / n[1] if n[1] else 1.0
    for r in range(1, top + 1):
        if n[r] and beyond < 1:
            factor = ((r + 1) * n[r + 1] / (r * n[r]) - beyond) / (1 - beyond)
            if 0 < factor < 1:
                out[r] = factor
    return out


def _factor(factors: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.where(counts < len(factors), factors[np.minimum(counts, len(factors) - 1)], 1.0)


def single_words(histogram: list[tuple[int, int]], end_count: int) -> Words:
    """The model from ``(count, words with it)`` and the count of the end; words are numbered by falling count."""
    histogram = sorted(histogram, reverse=True)
    count = np.array([c for c, _ in histogram], dtype=np.int64)
    words = np.array([n for _, n in histogram], dtype=np.int64)
    first = np.concatenate(([0], np.cumsum(words)))[: len(words)].astype(np.int64)
    every = {int(c): int(n) for c, n in histogram}
    if end_count:
        every[end_count] = every.get(end_count, 0) + 1
    tokens, size = sum(c * n for c, n in every.items()), sum(every.values())
    factors = discounts(every)
    prob = _factor(factors, count) * count / max(tokens, 1)
    end = float(_factor(factors, np.array([end_count]))[0] * end_count / max(tokens, 1))
    rest = 1 - float((prob * words).sum()) - end
    if rest < 1e-12 and tokens:  # nothing was discounted: one token's worth is kept for the unknown
        prob, end, rest = count / (tokens + 1), end_count / (tokens + 1), 1 / (tokens + 1)
    if not end_count:
        end = rest
    return Words(first, count, np.log10(prob), end_count, float(np.log10(end)), float(np.log10(rest)), tokens, size)


def _chunk_words(chunk: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a chunk's documents in order, and how many each document has."""
    found = []
    for batch in chunk.select(["text"]).combine_chunks().to_batches():
        for part in slices(batch, "text", 1 << 20):
            words = split_words(part.column("text"), lower=True)
            found.append((word_hashes(words), words.counts))
    return np.concatenate([h for h, _ in found]), np.concatenate([n for _, n in found])


def _parts(words: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket of sorted word hashes begins; buckets follow the order of the hashes."""
    of = ((words >> np.uint64(33)) * np.uint64(buckets)) >> np.uint64(31)
    return np.searchsorted(of, np.arange(buckets + 1))


def _count_words(buckets: int, chunk: pa.Table) -> pa.Table:
    """Distinct words of a chunk, and how often its training documents have them, packed for each bucket."""
    tokens, length = _chunk_words(chunk)
    held = chunk.column("held_out").to_numpy().astype(bool)
    words, of = np.unique(tokens, return_inverse=True)
    seen = np.bincount(of, weights=np.repeat(~held, length), minlength=len(words)).astype(np.uint32)
    edges = _parts(words, buckets)
    filled = np.flatnonzero(np.diff(edges))
    return pa.table(
        {
            "bucket": pa.array(filled, pa.int32()),
            "chunk": pa.array(np.full(len(filled), chunk.column("chunk")[0].as_py()), pa.int32()),
            "words": pa.array([words[edges[b] : edges[b + 1]].tobytes() for b in filled], pa.binary()),
            "n": pa.array([seen[edges[b] : edges[b + 1]].tobytes() for b in filled], pa.binary()),
        }
    )


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _sum_words(table: pa.Table) -> pa.Table:
    """The known words of a bucket with their counts, and how many words have each count."""
    words, of = np.unique(_joined(table.column("words"), np.uint64), return_inverse=True)
    count = np.bincount(of, weights=_joined(table.column("n"), np.uint32), minlength=len(words)).astype(np.int64)
    words, count = words[count > 0], count[count > 0]
    values, sizes = np.unique(count, return_counts=True)
    return pa.table(
        {
            "bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()),
            "words": pa.array([words.tobytes()], pa.binary()),
            "n": pa.array([count.tobytes()], pa.binary()),
            "counts": pa.array([values.tolist()], pa.list_(pa.int64())),
            "sizes": pa.array([sizes.tolist()], pa.list_(pa.int64())),
        }
    )


def _number_words(model: Words, asked: pa.Table, known: pa.Table) -> pa.Table:
    """The numbers of the words that each chunk has in this bucket, in the order of their hashes."""
    chunks, out = asked.column("chunk").to_pylist(), []
    if known.num_rows:
        row = known.to_pylist()[0]
        words, count = np.frombuffer(row["words"], np.uint64), np.frombuffer(row["n"], np.int64)
        order = np.argsort(-count, kind="stable")
        values, begin = np.unique(-count[order], return_index=True)
        place = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
        before = dict(zip(row["at"], row["before"], strict=True))
        first = dict(zip(model.count.tolist(), model.first.tolist(), strict=True))
        start = np.array([first[-v] + before[-v] for v in values.tolist()], dtype=np.int64)
        number = np.empty(len(words), dtype=np.int64)
        number[order] = place + np.repeat(start, np.diff(np.append(begin, len(order))))
    else:
        words, number = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for blob in asked.column("words"):
        mine = np.frombuffer(blob.as_buffer(), np.uint64)
        ids = np.full(len(mine), UNKNOWN, dtype=np.uint32)
        if len(words):
            at = np.minimum(np.searchsorted(words, mine), len(words) - 1)
            hit = words[at] == mine
            ids[hit] = number[at[hit]]
        out.append(ids.tobytes())
    return pa.table(
        {"chunk": pa.array(chunks, pa.int32()), "bucket": asked.column("bucket"), "ids": pa.array(out, pa.binary())}
    )


def _code_documents(model: Words, chunk: pa.Table, replies: pa.Table) -> pa.Table:
    """Documents of a chunk as numbers closed by the end, with what the single counts say about them."""
    tokens, length = _chunk_words(chunk)
    words, of = np.unique(tokens, return_inverse=True)
    numbers = _joined(replies.sort_by("bucket").column("ids"), np.uint32)
    if len(numbers) != len(words):
        raise ValueError("a chunk was read with other words than before")
    last = np.cumsum(length + 1) - 1
    ids = np.full(len(tokens) + len(length), END, dtype=np.uint32)
    inside = np.ones(len(ids), dtype=bool)
    inside[last] = False
    ids[inside] = numbers[of]
    count = model.counts(ids.astype(np.int64))
    cuts = np.concatenate(([0], last + 1))
    base = np.log10((count + 1) / (model.tokens + model.size + 1))
    return pa.table(
        {
            "chunk": chunk.column("chunk"),
            "doc_id": chunk.column("doc_id"),
            "held_out": chunk.column("held_out"),
            "n_tokens": pa.array(length + 1, pa.int64()),
            "n_known": np.add.reduceat((count > 0).astype(np.int64), cuts[:-1]),
            "base_score": np.add.reduceat(base, cuts[:-1]),
            "ids": pa.array([ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
        }
    )


@dataclass
class Run:
    """Consecutive documents of one chunk: their distinct pairs and known histories, each in bucket order."""

    of: np.ndarray  # the distinct pair of every token
    doc: np.ndarray  # the document of every token
    pairs: np.ndarray  # history << 32 | word
    pair_edges: np.ndarray  # where each bucket begins
    histories: np.ndarray
    history_edges: np.ndarray


def _bucket_order(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys by bucket, and where each bucket begins."""
    bucket = ((mix(keys) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _run(ids: pa.Array | pa.ChunkedArray, buckets: int) -> Run:
    raw = [np.frombuffer(i.as_buffer(), np.uint32) for i in ids]
    word = np.concatenate(raw).astype(np.uint64)
    length = np.array([len(r) for r in raw])
    history = np.empty_like(word)
    history[1:] = word[:-1]
    history[np.concatenate(([0], np.cumsum(length)[:-1]))] = END
    pairs, of = np.unique((history << np.uint64(32)) | word, return_inverse=True)
    histories = np.unique(pairs >> np.uint64(32))
    histories = histories[histories != UNKNOWN]
    order, pair_edges = _bucket_order(pairs, buckets)
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    by_bucket, history_edges = _bucket_order(histories, buckets)
    doc = np.repeat(np.arange(len(raw)), length)
    return Run(place[of], doc, pairs[order], pair_edges, histories[by_bucket], history_edges)


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Documents of one chunk that follow each other, with 8 MB of numbers at most (or one document)."""
    chunk, row = (batch.column(c).to_numpy() for c in ("chunk", "doc_row"))
    cuts = [0, *(np.flatnonzero((chunk[1:] != chunk[:-1]) | (row[1:] != row[:-1] + 1)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield from slices(batch.slice(a, b - a), "ids", 8 << 20)


def _asked_rows(part: pa.RecordBatch, edges: np.ndarray, **blobs: np.ndarray) -> pa.RecordBatch:
    filled = np.flatnonzero(np.diff(edges))
    columns = {
        "chunk": pa.array([part.column("chunk")[0].as_py()] * len(filled), pa.int32()),
        "first": pa.array([part.column("doc_row")[0].as_py()] * len(filled), pa.int64()),
        "bucket": pa.array(filled, pa.int32()),
    }
    for name, values in blobs.items():
        columns[name] = pa.array([values[edges[b] : edges[b + 1]].tobytes() for b in filled], pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def _ask_pairs(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct pairs of each run for their buckets, with how often its training documents have them."""
    for batch in batches:
        for part in _runs(batch):
            run = _run(part.column("ids"), buckets)
            held = part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            n = np.bincount(run.of, weights=~held[run.doc], minlength=len(run.pairs)).astype(np.uint32)
            h, w = (run.pairs >> np.uint64(32)).astype(np.uint32), run.pairs.astype(np.uint32)
            yield _asked_rows(part, run.pair_edges, h=h, w=w, n=n)


def _ask_histories(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct known histories of each run for their buckets."""
    for batch in batches:
        for part in _runs(batch):
            run = _run(part.column("ids"), buckets)
            yield _asked_rows(part, run.history_edges, h=run.histories.astype(np.uint32))


def _pairs(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return (h.astype(np.uint64) << np.uint64(32)) | w


def _count_pairs(asked: pa.Table) -> pa.Table:
    """The counts of each run's pairs in this bucket; and the bucket's count table, in rows of TABLE_PAIRS, the first with
    its number of pairs with each small count."""
    keys, of = np.unique(
        _pairs(_joined(asked.column("h"), np.uint32), _joined(asked.column("w"), np.uint32)), return_inverse=True
    )
    count = np.bincount(of, weights=_joined(asked.column("n"), np.uint32), minlength=len(keys)).astype(np.uint32)
    sizes = [len(b.as_buffer()) // 4 for b in asked.column("h")]
    edges = np.cumsum([0, *sizes])
    answers = [count[of[a:b]].tobytes() for a, b in zip(edges, edges[1:])]
    small = [int((count == r).sum()) for r in range(1, GT_MAX + 2)]
    keys, count = keys[count > 0], count[count > 0]
    cuts = [slice(a, a + TABLE_PAIRS) for a in range(0, len(keys), TABLE_PAIRS)]
    packed = [(keys >> np.uint64(32)).astype(np.uint32), keys.astype(np.uint32), count]
    blank, none = [None] * len(answers), [None] * len(cuts)
    return pa.table(
        {
            "chunk": pa.array(asked.column("chunk").to_pylist() + none, pa.int32()),
            "first": pa.array(asked.column("first").to_pylist() + none, pa.int64()),
            "bucket": pa.array(asked.column("bucket").to_pylist() + none, pa.int32()),
            "data": pa.array(answers + none, pa.binary()),
            **{c: pa.array(blank + [x[k].tobytes() for k in cuts], pa.binary()) for c, x in zip(("h", "w", "n"), packed)},
            "small": pa.array(blank + [small if not k.start else None for k in cuts], pa.list_(pa.int64())),
        }
    )


def _history_sums(
    model: Words, factors: np.ndarray, buckets: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """What a part of the count tables adds to its histories: discounted counts, and single-word probabilities."""
    for batch in batches:
        for row in zip(*(batch.column(c) for c in ("h", "w", "n"))):
            h, w, n = (np.frombuffer(x.as_buffer(), np.uint32) for x in row)
            history, of = np.unique(h, return_inverse=True)
            kept = np.bincount(of, weights=_factor(factors, n.astype(np.int64)) * n)
            single = np.bincount(of, weights=np.power(10.0, model.logs(w.astype(np.int64))))
            order, edges = _bucket_order(history.astype(np.uint64), buckets)
            filled = np.flatnonzero(np.diff(edges))
            columns = {"bucket": pa.array(filled, pa.int32())}
            for name, values in (("h", history[order]), ("kept", kept[order]), ("single", single[order])):
                columns[name] = pa.array([values[edges[b] : edges[b + 1]].tobytes() for b in filled], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)


def _weigh_histories(model: Words, asked: pa.Table, sums: pa.Table) -> pa.Table:
    """For each run's histories in this bucket: log10 of the backoff weight, then of what counts are divided by."""
    history, of = np.unique(_joined(sums.column("h"), np.uint32), return_inverse=True)
    kept = np.bincount(of, weights=_joined(sums.column("kept"), np.float64), minlength=len(history))
    single = np.bincount(of, weights=_joined(sums.column("single"), np.float64), minlength=len(history))
    total = model.counts(history.astype(np.int64)).astype(np.float64)
    share = kept / total
    whole = 1 - share < 1e-12  # nothing was discounted: one token's worth is kept for other words
    left = np.where(whole, 1 / (total + 1), 1 - share)
    weight = np.log10(left) - np.log10(np.maximum(1 - single, 1e-300))
    divisor = np.log10(total + whole)
    data = []
    for blob in asked.column("h"):
        mine = np.frombuffer(blob.as_buffer(), np.uint32)
        both = np.zeros((2, len(mine)))  # 0 for the end if nothing was trained: single-word probabilities stand alone
        if len(history):
            at = np.minimum(np.searchsorted(history, mine), len(history) - 1)
            hit = history[at] == mine
            both[:, hit] = weight[at[hit]], divisor[at[hit]]
        data.append(both.tobytes())
    return pa.table(
        {
            **{c: asked.column(c) for c in ("chunk", "first", "bucket")},
            "data": pa.array(data, pa.binary()),
        }
    )


def _score_chunk(model: Words, factors: np.ndarray, buckets: int, docs: pa.Table, replies: pa.Table) -> pa.Table:
    """The documents of a chunk with their scores.

    A counted pair has its discounted share; any other the history's weight times the single-word probability;
    after an unseen history the single-word probability stands alone.
    """
    docs, replies = docs.sort_by("doc_row"), replies.sort_by([("first", "ascending"), ("bucket", "ascending")])
    rows, first = docs.column("doc_row").to_numpy(), replies.column("first").to_numpy()
    of_pairs = replies.column("of_pairs").to_numpy(zero_copy_only=False).astype(bool)
    starts, scores = np.unique(first), []
    if not len(starts) or starts[0] != rows[0]:
        raise ValueError("a chunk was read with other documents than before")
    for start, a, b in zip(starts, np.searchsorted(rows, starts), np.append(np.searchsorted(rows, starts[1:]), len(rows))):
        run = _run(docs.column("ids").slice(a, b - a), buckets)
        mine = first == start
        count = _joined(replies.column("data").filter(pa.array(mine & of_pairs)), np.uint32).astype(np.int64)
        weighed = [np.frombuffer(x.as_buffer()) for x in replies.column("data").filter(pa.array(mine & ~of_pairs))]
        weight = np.concatenate([x[: len(x) // 2] for x in weighed])
        divisor = np.concatenate([x[len(x) // 2 :] for x in weighed])
        if len(count) != len(run.pairs) or len(weight) != len(run.histories):
            raise ValueError("a run was read with other pairs than before")
        order = np.argsort(run.histories)
        h = run.pairs >> np.uint64(32)
        known = h != UNKNOWN
        at = order[np.minimum(np.searchsorted(run.histories, h, sorter=order), len(order) - 1)]
        backed_off = model.logs((run.pairs & np.uint64(UNKNOWN)).astype(np.int64)) + np.where(known, weight[at], 0.0)
        share = np.log10(np.maximum(_factor(factors, count) * count, 1e-300)) - divisor[at]
        log = np.where(count > 0, share, backed_off)
        scores.append(np.bincount(run.doc, weights=log[run.of], minlength=b - a))
    kept = docs.select(["doc_id", "held_out", "n_tokens", "n_known", "base_score"])
    return kept.append_column("score", pa.array(np.concatenate(scores)))


def held_out(doc_id: str):
    """Whether a document is kept from training: crc32 of its id as text leaves 2 modulo 7."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 == 2, F.lit(False))


def score_documents(docs: DataFrame, is_held_out, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the rows where ``is_held_out`` is false and score all rows.

    One row per document: ``doc_id, held_out, n_tokens, n_known`` (tokens that training has),
    ``train_tokens, base_score`` (log10 under single counts plus one) and ``score`` (log10 under
    the backoff model). Null text is empty: it has one token, the end. Rows are scored one by one,
    so repeated rows and null ids stay apart. If nothing is left to train on, every token is the unknown
    class with probability 1. Runs jobs while it builds the result; the count tables stay in the shared folder.
    """
    given = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        is_held_out.alias("held_out"),
    )
    id_type = given.schema["doc_id"].dataType.simpleString()
    whole = given.agg(
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"),
        F.coalesce(F.count_if(~F.col("held_out")), F.lit(0)).alias("trained"),
    ).first()
    chunks = max(1, -(-whole["bytes"] // CHUNK_BYTES))
    word_buckets = max(1, -(-chunks // CHUNKS_PER_BUCKET))
    dealt = given.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))

    def count_words(chunk: pa.Table) -> pa.Table:
        return _count_words(word_buckets, chunk)

    counted = dealt.groupBy("chunk").applyInArrow(count_words, "bucket int, chunk int, words binary, n binary")
    listed = store(counted, "chunk-words")
    totals = store(
        listed.groupBy("bucket").applyInArrow(
            _sum_words, "bucket int, words binary, n binary, counts array<bigint>, sizes array<bigint>"
        ),
        "word-counts",
    )
    # Words of one count are numbered bucket after bucket.
    sizes = totals.select("bucket", F.inline(F.arrays_zip("counts", "sizes")))
    steps = sizes.groupBy("counts").agg(F.sum("sizes").alias("words")).collect()  # one row per different count
    model = single_words([(r["counts"], r["words"]) for r in steps], whole["trained"])
    earlier = Window.partitionBy("counts").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("before", F.coalesce(F.sum("sizes").over(earlier), F.lit(0)))
    offsets = offsets.groupBy("bucket").agg(F.collect_list(F.struct("counts", "before")).alias("o"))
    known = totals.join(offsets, "bucket").select(
        "bucket", "words", "n", F.col("o.counts").alias("at"), F.col("o.before").alias("before")
    )
    replies = (
        listed.select("bucket", "chunk", "words")
        .groupBy("bucket")
        .cogroup(known.groupBy("bucket"))
        .applyInArrow(partial(_number_words, model), "chunk int, bucket int, ids binary")
    )
    replies = store(replies, "word-numbers")
    discard(listed)
    shape = f"chunk int, doc_id {id_type}, held_out boolean, n_tokens long, n_known long, base_score double"
    coded = dealt.groupBy("chunk").cogroup(replies.groupBy("chunk"))
    coded = coded.applyInArrow(partial(_code_documents, model), f"{shape}, ids binary")
    coded = store(coded.withColumn("doc_row", F.monotonically_increasing_id()), "numbered-documents")
    discard(replies)

    tokens = coded.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    buckets = max(1, -(-tokens // BUCKET_TOKENS))
    asked = "chunk int, first long, bucket int, h binary"
    runs = coded.select("chunk", "doc_row", "held_out", "ids")
    pairs = store(
        runs.mapInArrow(partial(_ask_pairs, buckets), f"{asked}, w binary, n binary")
        .groupBy("bucket")
        .applyInArrow(
            _count_pairs,
            "chunk int, first long, bucket int, data binary, h binary, w binary, n binary, small array<bigint>",
        ),
        "pair-counts",
    )
    small = pairs.select(F.posexplode("small").alias("r", "n")).groupBy("r").agg(F.sum("n").alias("n")).collect()
    factors = discounts({r["r"] + 1: r["n"] for r in small})
    sums = (
        pairs.where("chunk IS NULL")
        .select("h", "w", "n")
        .mapInArrow(partial(_history_sums, model, factors, buckets), "bucket int, h binary, kept binary, single binary")
    )
    weights = (
        runs.mapInArrow(partial(_ask_histories, buckets), asked)
        .groupBy("bucket")
        .cogroup(sums.groupBy("bucket"))
        .applyInArrow(partial(_weigh_histories, model), "chunk int, first long, bucket int, data binary")
    )
    weights = store(weights, "history-weights")
    answers = pairs.where("chunk IS NOT NULL").select("chunk", "first", "bucket", "data", F.lit(True).alias("of_pairs"))
    answers = answers.unionByName(weights.withColumn("of_pairs", F.lit(False)))
    scored = (
        coded.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(partial(_score_chunk, model, factors, buckets), shape.removeprefix("chunk int, ") + ", score double")
    )
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score",
    )
