"""Ranked search against scores of all pairs, on awkward and empty tables."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

import brute
from fixtures import NAMELESS, REPEATED, SCHEMA, awkward, documents
from tidewheel.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranking(docs, items, k):
    """(item_id, rank, doc_id, score) by scoring every pair; docs and items are lists of (id, text)."""
    found = [(i, TERM.findall(brute.lower(t))) for i, t in docs]
    found = [(i, w) for i, w in found if w]
    n_docs, n_terms = len(found), sum(len(w) for _, w in found)
    counts = [(i, len(w), collections.Counter(w)) for i, w in found]
    df = collections.Counter(t for _, _, c in counts for t in c)
    rows = []
    for item, text in items:
        asked = TERM.findall(brute.lower(text))
        scores = []
        for i, n, c in counts:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = 0
            for t in asked:
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, 0 if i is None else i))
        rows += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(rows, key=repr)


def found(docs, items, **options):
    return sorted((tuple(r) for r in ranked.search(docs, items, **options).collect()), key=repr)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    zipf = [f"t{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    return awkward() | {300 + i: " ".join(rng.choices(zipf, k=rng.randrange(1, 60))) for i in range(150)} | {500: "Élan ÉLAN a_b A1b2"}


ITEM_SCHEMA = "item_id long, text string, rank int, doc_id string, item int, score double"


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, 1, "x", 2, 3.0) for i, t in items], ITEM_SCHEMA).repartition(3)


def questions(texts):
    rng = random.Random(7)
    items = [(i, " ".join(rng.sample((texts[t] or "").split(), min(len((texts[t] or "").split()), 25)))) for i, t in enumerate((5, 61, 98, 310, 311, 333, 400, 401))]
    return items + [(50, "w1 w1 w1 t1 T1"), (51, None), (52, ""), (53, "... !"), (54, "unheard-of words"), (55, "Élan a b a1B2"), (56, "one"), (50, "w3")]


def test_rankings_match_all_pairs(spark, texts):
    items = questions(texts)
    docs = documents(spark, texts, REPEATED + NAMELESS)
    rows = [*texts.items(), (3, "again"), (3, "again"), (None, "no id at all"), (None, None)]
    for k in (10, 1, 1000):
        assert found(docs, benchmark(spark, items), k=k) == ranking(rows, items, k)


def test_items_in_blocks_and_many_tasks(spark, texts, monkeypatch):
    monkeypatch.setattr(ranked, "ITEM_BLOCK_BYTES", 400)
    monkeypatch.setattr(ranked, "MERGE_PARTS", 3)
    items = questions(texts)
    docs = documents(spark, texts).repartition(29)
    assert found(docs, benchmark(spark, items), k=4) == ranking(list(texts.items()), items, 4)


def test_nothing_to_search_or_to_ask(spark, texts):
    nothing = spark.createDataFrame([], SCHEMA)
    blank = documents(spark, {1: None, 2: "", 3: "..."})
    some = benchmark(spark, [(1, "a"), (2, "w1")])
    none = spark.createDataFrame([], ITEM_SCHEMA)
    assert found(nothing, some) == found(blank, some) == []
    assert found(documents(spark, texts), none) == found(documents(spark, texts), benchmark(spark, [(1, None)])) == []


def test_text_ids_are_kept(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("", "x y z"), ("c", "q")], "doc_id string, text string")
    rows = ranked.search(docs, benchmark(spark, [(1, "x")]), k=3).orderBy("rank").collect()
    assert [r["doc_id"] for r in rows] == ["a", "b", None]  # the shorter texts first, null last


def test_common_terms_create_no_accumulators():
    """Once ten documents are far ahead the lists of common terms only update them, and results stay exact."""
    rng = np.random.default_rng(3)
    n = 2000
    lists, counts, sizes = [], [], []
    for d in range(n):
        held = {0: int(rng.integers(1, 4)), 1: int(rng.integers(1, 4))} | ({2: 3, 3: 2, 4: 1} if d % 180 == 7 else {})
        lists.append(list(held)), counts.append(list(held.values())), sizes.append(int(rng.integers(10, 90)))
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": pa.array(range(n)), "n": pa.array(sizes, pa.int64()), "terms": pa.array(lists, pa.list_(pa.int32())),
         "counts": pa.array(counts, pa.list_(pa.int64()))}
    )
    corpus = ranked.Corpus(n, sum(sizes), np.array([5, 6, 4000, 4100, 4200]))
    block = ranked.Block(corpus, batch)
    opened = []
    kth = block._kth
    block._kth = lambda k, rows, best: opened.append(sum(map(len, rows))) or kth(k, rows, best)
    question = ranked.Question(1, (4, 3, 2, 1, 0), (1, 1, 2, 1, 3))
    rows, scores = block.search(question, 10, np.zeros(0, np.int64))
    m = [25 + (75 * s * n) // sum(sizes) for s in sizes]
    exact = [sum(r * int(corpus.weights[t]) * ((10**9 * dict(zip(lists[d], counts[d])).get(t, 0)) // (1000 * dict(zip(lists[d], counts[d])).get(t, 0) + 8 * m[d])) for t, r in zip(question.terms, question.repeats)) for d in range(n)]
    best = sorted(range(n), key=lambda d: (-exact[d], d))[:10]
    assert rows.tolist() == best and scores.tolist() == [exact[d] for d in best]
    assert max(opened) == 12  # of 2,000 documents that hold a term
    assert not block.open.any() and not block.score.any()
    # Scores known from other blocks close this one before it begins.
    opened.clear()
    rows, _ = block.search(ranked.Question(2, (1, 0), (1, 1)), 10, np.full(10, 10**12))
    assert opened == [0] and not len(rows)
