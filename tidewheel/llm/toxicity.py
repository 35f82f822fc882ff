"""Toxicity by a weighted finite-state grammar over clauses.

A lexicon turns the words of a clause into classes: insults and threats with a weight each, targets, negations, reporting
verbs, and so on. Five small transducers read the classes one after the other: reported speech, negation, threats,
targets, and a judge that gives each marked insult or threat its offset or passes it over. They are composed into one
machine once. The score of a clause is its best path through that machine, so "you are an idiot" weighs more than
"idiot", and "nobody said you are an idiot" less. A document's score is logistic in its best clause, the sum over
its clauses and its length.

Weights of words and stems are cautious log-odds of toxic against clean training documents, counted on the cluster. The
logistic part is fitted on documents whose own fold took no part in the counts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.joins import BROADCAST_IDS, store
from tidewheel.llm.langid import held_out
from tidewheel.llm.textops import slices, split_words, window_hashes, word_hashes

SAMPLE_PER_LABEL = 5_000  # training documents of each label, about; the draw is by a hash of the id
LEXICON_SIZE = 20_000  # learned words and stems that go to the tasks
FOLDS = 4
MIN_DOCUMENTS = 3  # toxic training documents a learned word or stem must occur in
MIN_EVIDENCE = 15.0  # twice the log-likelihood ratio against chance; some 1e-4 of all chance words reach it
STEMS = range(4, 9)  # letters of a stem
SEED_WEIGHT = 2.0  # of listed insults and threats as long as training has hardly met them
SEED_DOCUMENTS = 5
COPY_SHINGLE = 5  # training documents that share their smallest shingle of so many words count once

# Words that carry the classes of the grammar, in four languages.
CLASSES = {
    "insult": """idiot idiots moron morons stupid scum loser losers trash pathetic worthless disgusting clown clowns dumb
        imbecile dummkopf trottel abschaum versager widerlich erbärmlich wertlos idiote imbécile crétin ordure minable
        débile idiota imbécil estúpido estúpida basura asqueroso asquerosa inútil patético""",
    "threat": """kill hurt beat destroy shoot stab hang murder strangle töten umbringen schlagen erschießen tuer frapper
        détruire matar golpear destruir""",
    "modal": """will gonna shall going i'll we'll they'll he'll she'll werde werden wird vais va allons allez voy vamos
        va vas""",
    "target": """you your you're youre u he she they them him her his their these those du dich dir dein ihr euch sie tu
        toi vous ton votre il elle ils elles tú te usted ustedes él ella ellos""",
    "negation": """not no never nobody none isn't aren't wasn't don't doesn't didn't won't nicht kein keine niemand nie pas
        jamais personne ningún nadie nunca jamás""",
    "report": """said says say wrote writes called calls claimed claims quoted told reported according sagte sagt schrieb
        nannte behauptet dit écrit appelé affirme dijo dice escribió llamó afirma""",
}
SEEDS = {word: tag for tag, words in CLASSES.items() for word in words.split()}

_WORD = re.compile(r"\w+(?:['’]\w+)?")
_TOKEN = re.compile(r"(\w+(?:['’]\w+)?)|([.!?;:\n\r]+)|(,)|([\"“”„«»])")
CORES = ("insult", "threat")


class Arc(NamedTuple):
    """A step: what it writes, what it adds, whether it takes the weight of the word, and where it leads."""

    out: str
    offset: float
    takes: bool
    state: object


class Transducer(NamedTuple):
    """A weighted transducer: ``arcs(state, symbol)`` lists the steps on reading a symbol."""

    start: object
    arcs: Callable[[object, str], Iterable[Arc]]


def _is_core(symbol: str) -> bool:
    return symbol.split("/")[0] in ("insult", "threat", "act")


def reported_speech() -> Transducer:
    """Marks what follows a reporting verb, or stands in quotes, as said by others."""

    def arcs(state: str, symbol: str) -> Iterable[Arc]:
        if symbol == "report":
            yield Arc("word", 0.0, False, "quoted" if state == "quoted" else "reported")
        elif symbol == "quote":
            yield Arc("word", 0.0, False, {"direct": "quoted", "quoted": "direct"}.get(state, state))
        else:
            yield Arc(f"{symbol}/said" if state != "direct" and _is_core(symbol) else symbol, 0.0, False, state)

    return Transducer("direct", arcs)


def negation(reach: int = 3) -> Transducer:
    """Marks insults and threats up to ``reach`` words after a negation."""

    def arcs(state: int, symbol: str) -> Iterable[Arc]:
        if symbol == "negation":
            yield Arc("word", 0.0, False, reach)
        elif _is_core(symbol):
            yield Arc(f"{symbol}/not" if state else symbol, 0.0, False, max(state - 1, 0))
        else:
            yield Arc(symbol, 0.0, False, 0 if symbol == "pause" else max(state - 1, 0))

    return Transducer(0, arcs)


def threats(reach: int = 4) -> Transducer:
    """A threatening verb up to ``reach`` words after a verb of intent becomes an act."""

    def arcs(state: int, symbol: str) -> Iterable[Arc]:
        if symbol == "modal":
            yield Arc("word", 0.0, False, reach)
        elif symbol.startswith("threat") and state:
            yield Arc(symbol.replace("threat", "act", 1), 0.0, False, state - 1)
        else:
            yield Arc(symbol, 0.0, False, 0 if symbol == "pause" else max(state - 1, 0))

    return Transducer(0, arcs)


def targets() -> Transducer:
    """Marks insults and threats in a clause that names somebody, before or after them."""

    def arcs(state: str, symbol: str) -> Iterable[Arc]:
        if symbol == "target":
            yield Arc("aim" if state == "open" else "word", 0.0, False, "named")
        elif _is_core(symbol):
            yield Arc(f"{symbol}/aimed" if state == "named" else symbol, 0.0, False, "named" if state == "named" else "open")
        else:
            yield Arc(symbol, 0.0, False, state)

    return Transducer("nobody", arcs)


OFFSETS = {"said": -1.5, "not": -2.5, "aimed": 1.0, "act": 1.0, "aim": 1.0}


def judge() -> Transducer:
    """Counts a marked word with its weight and the offsets of its marks, or passes it over."""

    def arcs(state: int, symbol: str) -> Iterable[Arc]:
        yield Arc("", 0.0, False, state)
        if _is_core(symbol):
            yield Arc("", sum(OFFSETS.get(part, 0.0) for part in symbol.split("/")), True, state or 1)
        elif symbol == "aim" and state:
            yield Arc("", OFFSETS["aim"], False, 2)  # once, and only if a word counts

    return Transducer(0, lambda s, x: [a for a in arcs(s, x) if not (x == "aim" and s == 2 and a.offset)])


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that feeds what ``first`` writes to ``second``."""

    def arcs(state: tuple, symbol: str) -> Iterable[Arc]:
        for a in first.arcs(state[0], symbol):
            for b in second.arcs(state[1], a.out):
                yield Arc(b.out, a.offset + b.offset, a.takes or b.takes, (a.state, b.state))

    return Transducer((first.start, second.start), arcs)


SYMBOLS = (*CLASSES, "quote", "pause", "word")


class Machine(NamedTuple):
    """A composed transducer with numbered states: ``steps[state][symbol]`` lists ``(offset, takes, state)``."""

    steps: list[dict[str, tuple[tuple[float, bool, int], ...]]]

    def best(self, symbols: list[str], weights: list[float]) -> float:
        """The weight of the best path over a clause."""
        open_states = {0: 0.0}
        for symbol, weight in zip(symbols, weights):
            reached: dict[int, float] = {}
            for state, so_far in open_states.items():
                for offset, takes, target in self.steps[state][symbol]:
                    total = so_far + offset + (weight if takes else 0.0)
                    if total > reached.get(target, -math.inf):
                        reached[target] = total
            open_states = reached
        return max(open_states.values())


def tabulate(machine: Transducer, symbols: Iterable[str] = SYMBOLS) -> Machine:
    """All states that can be reached, with their steps."""
    numbers, steps, todo = {machine.start: 0}, [], [machine.start]
    for state in todo:
        row = {}
        for symbol in symbols:
            found = []
            for arc in machine.arcs(state, symbol):
                if arc.state not in numbers:
                    numbers[arc.state] = len(numbers)
                    todo.append(arc.state)
                found.append((arc.offset, arc.takes, numbers[arc.state]))
            row[symbol] = tuple(found)
        steps.append(row)
    return Machine(steps)


def grammar() -> Transducer:
    """The five transducers in a row."""
    machine = reported_speech()
    for following in (negation(), threats(), targets(), judge()):
        machine = compose(machine, following)
    return machine


class Lexicon(NamedTuple):
    """Classes of words, with learned weights of whole words and of stems."""

    words: dict[str, float]
    stems: dict[str, float]

    def lookup(self, word: str) -> tuple[str, float]:
        """Class and weight of a lower-case word."""
        tag, weight = SEEDS.get(word, "word"), 0.0
        if tag in CORES:
            weight = SEED_WEIGHT
        elif tag != "word":
            return tag, 0.0
        if word in self.words:
            weight = self.words[word]
        else:
            for size in reversed(STEMS):
                if size <= len(word) and word[:size] in self.stems:
                    weight = max(weight, self.stems[word[:size]])
                    break
        return ("insult" if tag == "word" else tag, weight) if weight > 0 else ("word", 0.0)


class Clause(NamedTuple):
    start: int
    end: int
    weight: float


class Model(NamedTuple):
    """A lexicon and the logistic part: intercept, and factors of the features."""

    lexicon: Lexicon
    factors: tuple[float, ...]

    def score(self, clauses: list[Clause], n_words: int) -> float:
        z = sum(f * x for f, x in zip(self.factors, (1.0, *features(clauses, n_words))))
        return 1 / (1 + math.exp(-max(min(z, 700.0), -700.0)))


PRIOR = (-3.0, 0.8, 0.4, 0.0)  # factors as long as training lacks one of the labels


def features(clauses: list[Clause], n_words: int) -> tuple[float, float, float]:
    """Best clause, sum over clauses, length of the text."""
    weights = [c.weight for c in clauses]
    return max(weights, default=0.0), math.log1p(sum(weights)), math.log1p(n_words) / 10


class Reader:
    """Finds the weighted clauses of texts; remembers the words it has met."""

    MEMORY = 500_000

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon, self.machine, self.known = lexicon, tabulate(grammar()), {}

    def tag(self, word: str) -> tuple[str, float]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= self.MEMORY:
                self.known.clear()
            found = self.known[word] = self.lexicon.lookup(word.lower().replace("’", "'"))
        return found

    def clauses(self, text: str | None) -> tuple[list[Clause], int]:
        """The clauses with a weight above 0, by code points, and the number of words of the whole text."""
        words = _WORD.findall(text or "")
        if not any(self.tag(w)[0] in CORES for w in set(words)):
            return [], len(words)
        found: list[Clause] = []
        symbols: list[str] = []
        weights: list[float] = []
        start = end = None

        def close() -> None:
            if any(s in CORES for s in symbols):
                weight = self.machine.best(symbols, weights)
                if weight > 0:
                    found.append(Clause(start, end, weight))
            symbols.clear()
            weights.clear()

        for m in _TOKEN.finditer(text):
            word, stop, comma, quote = m.groups()
            if stop:
                close()
                start = None
                continue
            symbol, weight = self.tag(word) if word else ("pause" if comma else "quote", 0.0)
            symbols.append(symbol)
            weights.append(weight)
            start, end = m.start() if start is None else start, m.end()
        close()
        return found, len(words)


def _copy_keys(texts: pa.Array) -> list[int]:
    """The smallest hash of the shingles of each text: near copies mostly share it."""
    words = split_words(texts, lower=True)
    hashes = word_hashes(words)
    keys = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        size = min(COPY_SHINGLE, b - a)
        keys.append(int(window_hashes(hashes, np.arange(a, b - size + 1), size).min().view(np.int64)) if size else 0)
    return keys


def _with_copy_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            yield part.append_column("copy", pa.array(_copy_keys(part.column("text")), pa.int64()))


def candidates(text: str | None) -> set[str]:
    """Whole words, and stems with a star, of one text."""
    words = {w.lower().replace("’", "'") for w in set(_WORD.findall(text or ""))}
    stems = {f"{w[:size]}*" for w in words for size in STEMS if size <= len(w)}
    return {w for w in words if len(w) >= 3} | stems


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per candidate, fold and label, summed within a batch."""
    for batch in batches:
        for part in slices(batch, "text"):
            counts: Counter = Counter()
            for text, toxic, fold in zip(*(part.column(c).to_pylist() for c in ("text", "toxic", "fold"))):
                counts.update((c, fold, toxic) for c in candidates(text))
            if counts:
                (word, fold, toxic), n = zip(*counts), list(counts.values())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word, pa.string()), pa.array(fold, pa.int32()), pa.array(toxic, pa.int32()), pa.array(n, pa.int64())],
                    ["word", "fold", "toxic", "n"],
                )


def _weight(toxic: int, clean: int, all_toxic: int, all_clean: int) -> tuple[float, float]:
    """Smoothed log-odds less one deviation, and the evidence that the word is met in toxic documents more than by chance."""
    odds = math.log((toxic + 0.5) / (all_toxic + 1)) - math.log((clean + 0.5) / (all_clean + 1))
    share = all_toxic / (all_toxic + all_clean)
    expected = (toxic + clean) * share, (toxic + clean) * (1 - share)
    evidence = 2 * sum(n * math.log(n / e) for n, e in zip((toxic, clean), expected) if n)
    return odds - math.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5)), evidence if odds > 0 else 0.0


def _lexicon(counts: dict[str, tuple[int, int]], all_toxic: int, all_clean: int) -> Lexicon:
    words, stems = {}, {}
    for word, (toxic, clean) in counts.items():
        weight, evidence = _weight(toxic, clean, all_toxic, all_clean)
        if SEEDS.get(word) in CORES and toxic + clean >= SEED_DOCUMENTS:
            words[word] = max(weight, 0.0)
        elif toxic >= MIN_DOCUMENTS and weight > 0 and evidence >= MIN_EVIDENCE and SEEDS.get(word, "insult") in CORES:
            if word.endswith("*"):
                stems[word[:-1]] = weight
            else:
                words[word] = weight
    return Lexicon(words, stems)


def training_sample(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic"
) -> tuple[DataFrame, float]:
    """Store ``text, toxic, fold`` of some SAMPLE_PER_LABEL labelled documents a label that are not held out.

    The number beside the table is the share of toxic ones among all labelled ids that are not held out.

    They are drawn from the labels by a hash of the id, so that documents are read once and only joined to a list
    of that size. Ids labelled both ways are left out, of an id that repeats one text is taken, and of documents
    that share their smallest shingle (copies, mostly) one a label: copies must not pass for evidence.
    """
    known = labels.select(F.col(doc_id).cast("string").alias("id"), F.col(label).cast("int").alias("toxic"))
    known = known.where("id IS NOT NULL AND toxic IN (0, 1)").where(~held_out("id"))
    known = known.groupBy("id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
    known = known.where("toxic = other").select("id", "toxic")
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.create_map(*[F.lit(x) for y in (0, 1) for x in (y, SAMPLE_PER_LABEL / max(sizes.get(y, 0), 1))])
    draw = F.pmod(F.xxhash64("id", F.lit("draw")), F.lit(1 << 30)) / (1 << 30)
    drawn = store(known.where(draw < share[F.col("toxic")]), "drawn")
    small = drawn.count() <= BROADCAST_IDS
    rows = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).cast("string").alias("text"))
    rows = rows.where("text IS NOT NULL").join(F.broadcast(drawn) if small else drawn, "id")
    rows = rows.groupBy("id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    keyed = rows.mapInArrow(_with_copy_keys, "id string, toxic int, text string, copy long")
    rows = keyed.groupBy("copy", "toxic").agg(F.min_by("text", "id").alias("text"))
    fold = F.pmod(F.xxhash64("copy", F.lit("fold")), F.lit(FOLDS)).cast("int")
    sample = store(rows.select("text", "toxic", fold.alias("fold")), "training")
    return sample, sizes.get(1, 0) / max(sum(sizes.values()), 1)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Learn the weights of words and stems and the logistic part from labelled rows that are not held out.

    The driver gets the counts of LEXICON_SIZE words and stems at most, and three numbers for each sampled document.
    Without both labels the listed words and fixed factors are used.
    """
    sample, share = training_sample(docs, labels, doc_id, text, label)
    sizes = {(r["fold"], r["toxic"]): r["count"] for r in sample.groupBy("fold", "toxic").count().collect()}
    total = [sum(n for (_, y), n in sizes.items() if y == label) for label in (0, 1)]
    if not all(total):
        return Model(Lexicon({}, {}), PRIOR)
    counts = sample.mapInArrow(_counted, "word string, fold int, toxic int, n long")
    cells = [F.sum(F.when((F.col("fold") == f) & (F.col("toxic") == y), F.col("n")).otherwise(0)) for f in range(FOLDS) for y in (0, 1)]
    counts = counts.groupBy("word").agg(F.array(*cells).alias("cells"))
    sums = [reduce_sum("cells", y) for y in (0, 1)]
    odds = F.log((sums[1] + 0.5) / (total[1] + 1)) - F.log((sums[0] + 0.5) / (total[0] + 1))
    listed = F.col("word").isin([w for w, tag in SEEDS.items() if tag in CORES])
    low = odds - F.sqrt(1 / (sums[1] + 0.5) + 1 / (sums[0] + 0.5))
    kept = counts.where(listed | ((sums[1] >= MIN_DOCUMENTS) & (low >= 0.0)))
    rows = kept.orderBy(F.desc(low), "word").limit(LEXICON_SIZE).collect()
    lexicons = []
    for left_out in (*range(FOLDS), None):
        used = [f for f in range(FOLDS) if f != left_out]
        table = {r["word"]: tuple(sum(r["cells"][2 * f + y] for f in used) for y in (1, 0)) for r in rows}
        sides = [sum(sizes.get((f, y), 0) for f in used) for y in (1, 0)]
        lexicons.append(_lexicon(table, *sides))
    measured = sample.mapInArrow(partial(_measured, lexicons[:-1]), "toxic int, best double, total double, length double")
    data = np.array(sorted(tuple(r) for r in measured.collect()), dtype=float)
    return Model(lexicons[-1], logistic(data[:, 1:], data[:, 0], share))


def reduce_sum(cells: str, label: int):
    """The sum of the cells of one label over all folds."""
    return sum((F.col(cells)[2 * f + label] for f in range(1, FOLDS)), F.col(cells)[label]).cast("double")


def _measured(lexicons: list[Lexicon], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Label and features of training documents, by the lexicon that their fold took no part in."""
    readers = [Reader(lexicon) for lexicon in lexicons]
    for batch in batches:
        rows = []
        for text, toxic, fold in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "fold"))):
            rows.append((toxic, *features(*readers[fold].clauses(text))))
        columns = list(zip(*rows)) or [()] * 4
        kinds = (pa.int32(), pa.float64(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["toxic", "best", "total", "length"]
        )


def logistic(x: np.ndarray, y: np.ndarray, share: float, ridge: float = 0.5, steps: int = 50) -> tuple[float, ...]:
    """Intercept and factors of a ridge regression; labels weigh as in a corpus with this ``share`` of ones."""
    x = np.column_stack([np.ones(len(x)), x])
    seen = max(y.mean(), 1e-9), max(1 - y.mean(), 1e-9)
    weight = np.where(y == 1, share / seen[0], (1 - share) / seen[1])
    penalty = np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    factors = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ factors, -30, 30)))
        slope = x.T @ (weight * (y - p)) - penalty @ factors
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + penalty
        change = np.linalg.solve(curve, slope)
        factors += np.clip(change, -2, 2)
        if np.abs(change).max() < 1e-9:
            break
    return tuple(float(f) for f in factors)


def score_toxicity(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, score, n_words, clauses`` (array of start, end and weight, in code points).

    The whole text is read. Null, empty and wordless texts have no clause and the score of an empty text.
    Rows are judged one by one: repeated rows, null ids and other columns change nothing. Nothing is shuffled.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.lexicon)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("weight", pa.float64())]))
        for batch in batches:
            for part in slices(batch, "text"):
                found = [reader.clauses(t) for t in part.column("text").to_pylist()]
                columns = [
                    part.column("doc_id"),
                    pa.array([model.score(*f) for f in found], pa.float64()),
                    pa.array([n for _, n in found], pa.int64()),
                    pa.array([[c._asdict() for c in clauses] for clauses, _ in found], kind),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "n_words", "clauses"])

    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return given.mapInArrow(
        scored,
        f"doc_id {given.schema['doc_id'].dataType.simpleString()}, score double, n_words long, "
        "clauses array<struct<start: int, end: int, weight: double>>",
    )
