"""Ranked lexical search: term-at-a-time over stored term lists, with a limit on accumulators.

The index holds one row per document: its number of terms, and for every term that some item asks for how often it
occurs. Tasks walk over blocks of documents. For each item a block's posting lists are met from the rarest term of
the corpus to the commonest. A document gets an accumulator when one of the first terms meets it; as soon as the largest
contributions that the remaining lists can make sum to less than the k-th best partial score (of this block's
accumulators and of finished blocks of the task), no document without one can reach the top any more: from there on
lists only update documents that have one. So survivors get their exact score, and common terms create nothing.
The best of all tasks are merged in two steps.

Scores are 64-bit integers, so results do not depend on how documents are dealt.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import partial, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.joins import discard, store
from tidewheel.llm.textops import slices
from tidewheel.scratch import materialise

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # ASCII letters and digits, and everything beyond ASCII
ITEM_BLOCK_BYTES = 8 << 20  # item texts that are searched together; their vocabulary goes to every task
MERGE_PARTS = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")  # TERM on UTF-8
_LOWER_BYTES = bytes.maketrans(_UPPER.encode(), _LOWER.encode())


def terms(text: str | None) -> list[bytes]:
    """The terms of a text as UTF-8, A-Z lower-cased; null has none."""
    return _TERM_BYTES.findall((text or "").encode().translate(_LOWER_BYTES))


def _listed(vocabulary: dict[bytes, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows of the documents that have a term."""
    for batch in batches:
        for part in slices(batch, "text"):
            kept, sizes, ids, counts = [], [], [], []
            for row, text in enumerate(part.column("text").to_pylist()):
                found = terms(text)
                if found:
                    known = Counter(map(vocabulary.get, found))
                    known.pop(None, None)
                    kept.append(row)
                    sizes.append(len(found))
                    ids.append(list(known))
                    counts.append(list(known.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(kept, pa.int64())),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "terms", "counts"],
            )


def build_index(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Store ``doc_id, n, terms, counts`` of every document with at least one term; lists hold the vocabulary's terms only."""
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    listed = given.mapInArrow(
        partial(_listed, vocabulary), f"doc_id {kind}, n long, terms array<int>, counts array<long>"
    )
    return store(listed, "term-lists")


class Question(NamedTuple):
    """An item: its distinct terms from the rarest to the commonest, and how often it holds each."""

    item: int
    terms: tuple[int, ...]
    repeats: tuple[int, ...]


class Corpus(NamedTuple):
    """Documents with a term, all their terms, and the weight of each term of the vocabulary."""

    n_docs: int
    n_terms: int
    weights: np.ndarray


def contribution(corpus: Corpus, term: np.ndarray, count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """What one occurrence of a term in an item adds to the score of a document of ``size`` terms that holds it ``count`` times."""
    m = 25 + (75 * size * corpus.n_docs) // corpus.n_terms
    return corpus.weights[term] * ((1_000_000_000 * count) // (1000 * count + 8 * m))


class Block:
    """Posting lists of a block of documents, whose rows are in the order of their ids."""

    def __init__(self, corpus: Corpus, batch: pa.RecordBatch) -> None:
        lists = batch.column("terms")
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        term = lists.flatten().to_numpy()
        row = np.repeat(np.arange(batch.num_rows), sizes)
        count, size = batch.column("counts").flatten().to_numpy(), batch.column("n").to_numpy()
        by_term = np.argsort(term, kind="stable")
        self.row = row[by_term]
        self.gain = contribution(corpus, term, count, size[row])[by_term]
        self.first = np.searchsorted(term[by_term], np.arange(len(corpus.weights) + 1))
        self.score = np.zeros(batch.num_rows, dtype=np.int64)  # accumulators, used by one item after the other
        self.open = np.zeros(batch.num_rows, dtype=bool)

    def search(self, question: Question, k: int, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best documents above 0, given the ``best`` scores already known elsewhere."""
        lists = [slice(*self.first[t : t + 2]) for t in question.terms]
        most = [r * int(self.gain[at].max(initial=0)) for at, r in zip(lists, question.repeats)]
        left = sum(most)
        opened: list[np.ndarray] = []
        creating = left >= self._kth(k, opened, best)
        for at, bound, repeats in zip(lists, most, question.repeats):
            left -= bound
            rows = self.row[at]
            if not len(rows):
                continue
            if creating:
                new = rows[~self.open[rows]]
                self.open[new] = True
                opened.append(new)
                self.score[rows] += repeats * self.gain[at]
                creating = left >= self._kth(k, opened, best)
            else:
                met = self.open[rows]
                self.score[rows[met]] += repeats * self.gain[at][met]
        if not opened:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        rows = np.sort(np.concatenate(opened))
        scores = self.score[rows]
        self.score[rows], self.open[rows] = 0, False
        rows, scores = rows[scores > 0], scores[scores > 0]
        top = np.argsort(-scores, kind="stable")[:k]  # equal scores stay in the order of ids
        return rows[top], scores[top]

    def _kth(self, k: int, opened: list[np.ndarray], best: np.ndarray) -> int:
        """The k-th best partial score; -1 if there are fewer."""
        known = np.concatenate([best, *(self.score[rows] for rows in opened)])
        return int(np.partition(known, len(known) - k)[len(known) - k]) if len(known) >= k else -1


def _order(pair: tuple[int, object]) -> tuple:
    score, doc_id = pair
    return -score, doc_id is None, 0 if doc_id is None else doc_id


def _searched(
    corpus: Corpus, questions: list[Question], k: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """The k best documents of a task for each item."""
    found: dict[int, list[tuple[int, object]]] = {}
    kind = None
    for batch in batches:
        kind = batch.schema.field("doc_id").type
        batch = batch.take(pc.sort_indices(batch.column("doc_id")))  # nulls last
        ids = batch.column("doc_id")
        block = Block(corpus, batch)
        for question in questions:
            known = found.get(question.item, [])
            rows, scores = block.search(question, k, np.array([s for s, _ in known], dtype=np.int64))
            if len(rows):
                new = zip(scores.tolist(), ids.take(pa.array(rows)).to_pylist())
                merged = sorted([*known, *new], key=_order)
                found[question.item] = merged[:k]
    if found:
        rows = [(item, doc_id, score) for item, best in found.items() for score, doc_id in best]
        item, doc_id, score = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array(doc_id, kind), pa.array(score, pa.int64())], ["item", "doc_id", "score"]
        )


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each item with their rank; parts of the tasks first, so no group grows with the tasks alone."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = (F.spark_partition_id() % MERGE_PARTS).alias("part")
    in_part = F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))
    kept = found.select("*", part).withColumn("rank", in_part).where(F.col("rank") <= k)
    return kept.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def _block_results(docs: DataFrame, rows: list, k: int, doc_id: str, text: str) -> DataFrame:
    """Search one block of items, given as rows of ``item, text``."""
    asked = {r["item"]: Counter(terms(r["text"])) for r in rows}
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*asked.values())))}
    index = build_index(docs, vocabulary, doc_id, text)
    totals = index.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n_docs = totals["docs"]
    holders = np.zeros(len(vocabulary), dtype=np.int64)
    for term, df in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        holders[term] = df
    weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in holders.tolist()]
    corpus = Corpus(n_docs, totals["terms"], np.array(weights, dtype=np.int64))
    questions = []
    for item, counts in asked.items():
        order = sorted((int(holders[vocabulary[t]]), vocabulary[t], r) for t, r in counts.items())
        met = [(t, r) for df, t, r in order if df]
        if met:
            questions.append(Question(item, *zip(*met)))
    kind = index.schema["doc_id"].dataType.simpleString()
    found = index.mapInArrow(partial(_searched, corpus, questions, k), f"item long, doc_id {kind}, score long")
    best = materialise(_best(found, k), "ranking")
    discard(index)
    return best


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id, rank, doc_id, score``.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased, over whole texts. Scores sum,
    over the terms of the item with repeats, a weight that falls with the number of documents that hold the term times a
    share that grows with its occurrences and falls with the document's length. Only scores above 0 are
    listed, equal ones by ascending id (null last), and ranks are unique. Null, empty and termless texts are no
    documents and find nothing. Every row counts for itself: repeated rows are documents of their own, and an item id that occurs twice
    is answered twice. Other columns are not read.

    Items are taken in blocks of some ITEM_BLOCK_BYTES of text: only a block's vocabulary goes to the driver
    and the tasks, whatever the number of items. Runs jobs; results are stored.
    """
    asked = materialise(
        items.select(
            F.monotonically_increasing_id().alias("item"),
            F.col(item_id).alias("item_id"),
            F.col(item_text).cast("string").alias("text"),
        ).where(F.col("text").isNotNull()),
        "items",
    )
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // ITEM_BLOCK_BYTES))
    found = []
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).select("item", "text").collect()
        found.append(_block_results(docs, rows, k, doc_id, text))
    best = reduce(DataFrame.unionAll, found)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


# The same rows from all pairs of an item and a document that share a term.
ORACLE = rf"""
WITH lowered AS (
    SELECT 'doc' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'item', item_id, text FROM benchmark),
listed AS (
    SELECT kind, id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{TERM}') AS t FROM lowered),
counted AS (SELECT kind, id, len(t) AS n, term, count(*) AS tf
    FROM (SELECT kind, id, t, unnest(t) AS term FROM listed) GROUP BY kind, id, t, term),
sizes AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM listed WHERE kind = 'doc' AND len(t) > 0),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counted, sizes WHERE kind = 'doc' GROUP BY term),
scores AS (SELECT i.id AS item_id, d.id AS doc_id,
        CAST(sum(i.tf * w * ((1000000000 * d.tf) // (1000 * d.tf + 8 * (25 + (75 * d.n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM counted i JOIN counted d USING (term) JOIN weights USING (term), sizes
    WHERE i.kind = 'item' AND d.kind = 'doc' GROUP BY i.id, d.id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""
