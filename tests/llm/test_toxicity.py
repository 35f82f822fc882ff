"""The toxicity grammar against an enumeration of all paths, and learning on planted documents."""

import itertools
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fixtures import NAMELESS, REPEATED, SCHEMA, awkward, documents
from tidewheel.llm import toxicity
from tidewheel.llm.langid import held_out
from tidewheel.llm.toxicity import Lexicon, Model, Reader

LABELS = "doc_id long, quality int, toxic int, text string, id string, copy long"


def plain(symbols, weights):
    """The best weight over all ways through the five transducers, one after the other, in full."""
    ways = [(0.0, list(symbols), [False] * len(symbols))]
    for machine in (toxicity.reported_speech(), toxicity.negation(), toxicity.threats(), toxicity.targets(), toxicity.judge()):
        following = []
        for so_far, written, _ in ways:
            paths = [(so_far, machine.start, [], [])]
            for symbol in written:
                paths = [
                    (w + a.offset, a.state, out + [a.out], takes + [a.takes])
                    for w, state, out, takes in paths
                    for a in machine.arcs(state, symbol)
                ]
            following += [(w, out, takes) for w, _, out, takes in paths]
        ways = following
    return max(w + sum(x for x, t in zip(weights, takes) if t) for w, _, takes in ways)


def test_composed_machine_finds_the_best_path():
    machine = toxicity.tabulate(toxicity.grammar())
    rng = random.Random(2)
    for _ in range(400):
        symbols = rng.choices(toxicity.SYMBOLS, k=rng.randrange(1, 7))
        weights = [rng.choice((0.5, 2.0, 5.0)) if s in toxicity.CORES else 0.0 for s in symbols]
        assert machine.best(symbols, weights) == pytest.approx(plain(symbols, weights))


def best(text, lexicon=Lexicon({}, {})):
    return max((c.weight for c in Reader(lexicon).clauses(text)[0]), default=0.0)


def test_clauses_are_weighed_by_their_context():
    word = best("an idiot")
    assert word == toxicity.SEED_WEIGHT
    assert best("You are an idiot") == best("idiot, you") == word + 1
    assert best("not an idiot") == best("He said something. Nobody is an idiot.") == 0
    assert best("the word, she said, was idiot") < best("you idiot")
    assert best('they shouted "idiot"') < best("they shouted idiot")
    assert best("I will kill you") > best("to kill time") > 0
    assert best("I will kill you. not an idiot") == best("I will kill you")
    assert best("the tree is green") == 0
    assert best("idiot " * 3) == 3 * word


def test_lexicon_prefers_words_then_the_longest_stem():
    lexicon = Lexicon({"abcdef": 1.0, "idiot": 0.0}, {"abcd": 2.0, "abcdefg": 3.0})
    assert [lexicon.lookup(w)[1] for w in ("abcdef", "abcdx", "abcdefgh", "abc", "idiot")] == [1.0, 2.0, 3.0, 0.0, 0.0]
    assert lexicon.lookup("you") == ("target", 0.0)


def test_spans_are_code_points_of_the_text():
    text = "İ 𝒳 fine. ÉÉ you idiot! ok"
    (clause,), n = Reader(Lexicon({}, {})).clauses(text)
    assert text[clause.start : clause.end] == "ÉÉ you idiot" and n == 7


def planted(seed, n=1200):
    """Documents with a hidden vocabulary of insults: listed stems with changing ends, and one whole word."""
    rng = random.Random(seed)
    plain_words = ["".join(rng.choices("abcdeilmnorstu", k=rng.randrange(2, 9))) for _ in range(3000)]
    ends = ["a", "en", "ist", "orum", "ux"]
    docs, labels = {}, []
    for i in range(n):
        words = rng.choices(plain_words, k=rng.randrange(5, 120))
        toxic = rng.random() < 0.12
        for _ in range(rng.randrange(2, 6) if toxic else 0):
            insult = rng.choice(["zwick" + rng.choice(ends), "krolp" + rng.choice(ends), "vex"])
            words.insert(rng.randrange(len(words)), insult)
        docs[i] = " ".join(words)
        if i % 5:
            labels.append((i, 1, int(toxic)))
    truth = {i: any(w.startswith(("zwick", "krolp")) or w == "vex" for w in t.split()) for i, t in docs.items()}
    return docs, labels, truth


def label_table(spark, labels):
    return spark.createDataFrame([(i, q, y, "t", "i", 0) for i, q, y in labels], LABELS).repartition(3)


def test_learned_words_and_stems_reach_held_out_documents(spark):
    texts, labels, truth = planted(1)
    odd = [(5, 1, None), (None, 1, 1), (99_999, 1, 1), (7, 1, 0), (7, 1, 1)]  # no label, no id, no document, both labels
    docs = documents(spark, texts, REPEATED + NAMELESS)
    model = toxicity.fit(docs, label_table(spark, labels + odd))
    assert {"zwic", "krol"} <= {s[:4] for s in model.lexicon.stems} and "vex" in model.lexicon.words
    rows = toxicity.score_toxicity(docs, model).withColumn("held_out", held_out("doc_id")).collect()
    assert len(rows) == len(texts) + len(REPEATED) + len(NAMELESS) and all(0 <= r["score"] <= 1 for r in rows)
    judged = [(truth[r["doc_id"]], r["score"] >= 0.3) for r in rows if r["held_out"] and r["doc_id"] not in (None, 3)]
    caught = [p for t, p in judged if t]
    assert len(caught) > 20 and sum(caught) / len(caught) >= 0.95
    clean = [p for t, p in judged if not t]
    assert sum(clean) / len(clean) <= 0.01
    unseen = {1: "so a zwickelot came", 2: "so a zebra came"}  # an end that training never met
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(documents(spark, unseen), model).collect()}
    assert scores[1] > scores[2]


def test_held_out_rows_teach_nothing(spark):
    texts, labels, _ = planted(2, 300)
    docs = documents(spark, texts)
    kept_out = {r[0] for r in docs.where(held_out("doc_id")).select("doc_id").collect()}
    turned = [(i, q, 1 - y if i in kept_out else y) for i, q, y in labels]
    assert toxicity.fit(docs, label_table(spark, labels)) == toxicity.fit(docs, label_table(spark, turned))


def test_copies_are_no_evidence(spark):
    texts, labels, _ = planted(3, 400)
    texts |= {1000 + i: "zebra crossing ahead of the old town hall today" for i in range(300)}
    labels += [(1000 + i, 1, 1) for i in range(300)]
    model = toxicity.fit(documents(spark, texts), label_table(spark, labels))
    assert "zebra" not in model.lexicon.words and not any("zebra".startswith(s) for s in model.lexicon.stems)


def test_nulls_blanks_and_missing_labels(spark):
    docs = documents(spark, awkward(), REPEATED + NAMELESS)
    for labels in ([], [(1, 1, 0), (2, 1, 0)], [(1, 1, None)]):
        model = toxicity.fit(docs, label_table(spark, labels))
        assert model.factors == toxicity.PRIOR
        rows = toxicity.score_toxicity(docs, model).collect()
        assert len(rows) == len(awkward()) + 4
        empty = model.score([], 0)
        assert {r["score"] for r in rows if r["doc_id"] in (90, 91, 92)} == {empty}
    nothing = spark.createDataFrame([], SCHEMA)
    assert toxicity.score_toxicity(nothing, toxicity.fit(nothing, label_table(spark, [(1, 1, 1)]))).collect() == []


def test_near_copies_share_their_key():
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words), " ".join(words[:-1]) + " end", "a b", "a  B", "", None]
    keys = toxicity._copy_keys(pa.array(texts, pa.string()))
    assert keys[0] == keys[1] and keys[2] == keys[3] != keys[0] and keys[4] == keys[5] == 0


def test_candidates_are_words_and_stems():
    assert toxicity.candidates("Abcdef ab") == {"abcdef", "abcd*", "abcde*", "abcdef*"}
    assert toxicity.candidates(None) == set()
