"""Awkward documents for all operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, component string, key int, word int"


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out


def awkward(seed=3):
    """Texts by id: near and exact copies, shared passages, ties, blanks, nulls and one very long text."""
    rng = random.Random(seed)
    texts = {}
    base = [words(rng, 120) for _ in range(6)]
    for i in range(60):
        b = base[i % 6]
        texts[i] = " ".join(b if i % 5 == 0 else edited(rng, b, rng.randrange(1, 9)))
    passage = words(rng, 70)
    for i in range(60, 90):
        own = words(rng, rng.randrange(5, 90))
        at = rng.randrange(len(own))
        texts[i] = "  ".join(own[:at] + passage[rng.randrange(15) :] + own[at:])
    texts |= {90: None, 91: "", 92: " \t\n\x0b", 93: "one", 94: "one", 95: "One two three", 96: "...", 97: " é ß"}
    texts[98] = "\n".join(words(rng, 30_000, 50))
    texts[99] = "x" * 200_000
    return texts


def documents(spark, texts, extra=()):
    """The texts as a table with more columns than needed, some rows twice, and rows without an id."""
    rows = [(i, t, "en", "s", None if t is None else len(t), "r", "c", 1, 2) for i, t in texts.items()]
    return spark.createDataFrame([*rows, *extra], SCHEMA).repartition(5)


REPEATED = [(3, "again", None, None, 5, None, None, None, None)] * 2
NAMELESS = [(None, "no id at all", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
