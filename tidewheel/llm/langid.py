"""Language identification by a bidirectional gated recurrent network over bytes.

Trained in numpy by backpropagation through time on a bounded sample of labelled rows;
applied to whole texts where they are read. A text is cut into windows of WINDOW bytes;
in each, one network reads forwards and one backwards, and every byte gets a probability
for each language from both states. A document's probabilities are the mean over all of its
bytes, so a long text costs time in proportion and memory for one batch of windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewheel.llm.textops import raw_bytes, slices

WINDOW = 64
BATCH = 2048
HIDDEN = 8
SAMPLE_PER_LABEL = 500  # documents of each label that training may see
SPARE = 8  # times as many are considered for it
EXCERPTS, EXCERPT_CHARS = 4, 96
STEPS = 200
UNKNOWN = "und"

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True


@dataclass
class Model:
    """Weights per direction and gate (update, reset, new): ``x`` (3, 256, H) holds input and bias of every byte,
    ``u`` (3, H, H) and ``v`` (1, H, of the new gate) read the state; ``out`` (2H + 1, L) gives a score per label."""

    labels: list[str]
    x: list[np.ndarray]
    u: list[np.ndarray]
    v: list[np.ndarray]
    out: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return [*self.x, *self.u, *self.v, self.out]


def new_model(labels: list[str], hidden: int = HIDDEN, seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    return Model(
        labels,
        [draw(3, 256, hidden, scale=0.4) for _ in range(2)],
        [draw(3, hidden, hidden, scale=hidden**-0.5) for _ in range(2)],
        [np.zeros((1, hidden), np.float32) for _ in range(2)],
        draw(2 * hidden + 1, len(labels), scale=0.3),
    )


def _squash(a: np.ndarray) -> np.ndarray:
    """a / (1 + |a|), in place of tanh: a few plain passes instead of an exponential."""
    below = np.abs(a)
    below += 1
    a /= below
    return a


def _gate(a: np.ndarray) -> np.ndarray:
    a = _squash(a)
    a *= 0.5
    a += 0.5
    return a


def _step(x: np.ndarray, u: np.ndarray, v: np.ndarray, byte: np.ndarray, h: np.ndarray):
    """One step of windows (B): the new state (B, H), and what the backward pass needs."""
    a = np.take(x[0], byte, axis=0, mode="clip")
    a += h @ u[0]
    z = _gate(a)
    a = np.take(x[1], byte, axis=0, mode="clip")
    a += h @ u[1]
    r = _gate(a)
    carried = h @ u[2]
    carried += v
    new = np.take(x[2], byte, axis=0, mode="clip")
    new += r * carried
    new = _squash(new)
    after = h - new
    after *= z
    after += new
    return after, (z, r, new, carried)


def _softmax(scores: np.ndarray) -> np.ndarray:
    """Probabilities along the last axis."""
    scores -= scores.max(axis=-1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=-1, keepdims=True)
    return scores


def gradients(model: Model, text: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all positions of full windows ``text`` (T, B), and its gradient for each weight."""
    steps, batch = text.shape
    size = model.u[0].shape[1]
    kind = model.out.dtype
    states, kept = np.zeros((2, steps, batch, size), kind), [[None] * steps, [None] * steps]
    for d, order in enumerate((range(steps), range(steps - 1, -1, -1))):
        h = np.zeros((batch, size), kind)
        for t in order:
            before = h
            h, saved = _step(model.x[d], model.u[d], model.v[d], text[t], h)
            states[d, t], kept[d][t] = h, (before, *saved)
    wide = np.concatenate([states[0], states[1], np.ones((steps, batch, 1), kind)], axis=2)
    prob = _softmax(wide @ model.out)
    at = np.broadcast_to(label[None, :, None], (steps, batch, 1))
    picked = np.take_along_axis(prob, at, axis=2)
    loss = float(-np.log(np.maximum(picked, 1e-12)).mean())
    np.put_along_axis(prob, at, picked - 1, axis=2)
    delta = prob / kind.type(steps * batch)
    grad_out = wide.reshape(-1, wide.shape[2]).T @ delta.reshape(-1, delta.shape[2])
    grads = [[np.zeros_like(w) for w in group] for group in (model.x, model.u, model.v)]
    for d, order in enumerate((range(steps - 1, -1, -1), range(steps))):
        from_out = delta @ model.out[d * size : (d + 1) * size].T
        dh = np.zeros((batch, size), kind)
        for t in order:
            before, z, r, new, carried = kept[d][t]
            dh = dh + from_out[t]
            d_new = dh * (1 - z) * (1 - np.abs(new)) ** 2
            d_z = dh * (before - new) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
            d_r = d_new * carried * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
            hot = (text[t][None, :] == np.arange(256)[:, None]).astype(kind)
            dh = dh * z
            for g, (given, state) in enumerate(((d_z, d_z), (d_r, d_r), (d_new, d_new * r))):
                grads[0][d][g] += hot @ given
                grads[1][d][g] += before.T @ state
                dh += state @ model.u[d][g].T
            grads[2][d] += (d_new * r).sum(axis=0, keepdims=True)
    return loss, [*grads[0], *grads[1], *grads[2], grad_out]


def train(texts: list[bytes], labels: list[str], hidden: int = HIDDEN, steps: int = STEPS, seed: int = 7) -> Model:
    """Fit by Adam on random windows of the texts, drawing every label equally often."""
    names = sorted(set(labels))
    model = new_model(names, hidden, seed)
    rng = np.random.default_rng(seed)
    windows = [
        (np.frombuffer(t[a : a + WINDOW], np.uint8), names.index(y))
        for t, y in zip(texts, labels, strict=True)
        for a in range(0, max(len(t) - WINDOW // 2, 1), WINDOW // 2)
        if len(t[a : a + WINDOW]) == WINDOW
    ]
    if not windows:  # only very short texts: repeat them to a window
        windows = [
            (np.resize(np.frombuffer(t, np.uint8), WINDOW), names.index(y)) for t, y in zip(texts, labels) if t
        ]
    if not windows:
        return model
    data = np.stack([w for w, _ in windows])
    of = np.array([y for _, y in windows])
    pools = [np.flatnonzero(of == y) for y in range(len(names))]
    pools = [p for p in pools if len(p)]
    first, second = [np.zeros_like(w) for w in model.weights()], [np.zeros_like(w) for w in model.weights()]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(p, max(1, 192 // len(pools))) for p in pools])
        _, grads = gradients(model, np.ascontiguousarray(data[pick].T), of[pick])
        scale = min(1.0, 1.0 / (1e-9 + float(np.sqrt(sum((g * g).sum() for g in grads)))))
        rate = 0.02 * min(1.0, step / 20) * (0.5 + 0.5 * np.cos(np.pi * step / steps)) + 1e-4
        for w, g, m, s in zip(model.weights(), grads, first, second, strict=True):
            g = g * np.float32(scale)
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def position_probabilities(model: Model, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator:
    """For windows sorted by falling length: ``t, n, prob`` with the label probabilities (n, L) of the windows' bytes t.

    Only the first n windows reach byte t, so short windows need no padding.
    """
    size, longest = model.u[0].shape[1], int(lengths[0])
    alive = np.searchsorted(-lengths, -np.arange(longest), side="left")
    text = data[np.minimum(starts[None, :] + np.arange(longest)[:, None], len(data) - 1)].astype(np.intp)
    ahead, h = [], np.zeros((len(starts), size), np.float32)
    for t in range(longest):
        h, _ = _step(model.x[0], model.u[0], model.v[0], text[t, : alive[t]], h[: alive[t]])
        ahead.append(h)
    h = np.zeros((0, size), np.float32)
    left, right, bias = model.out[:size], model.out[size:-1], model.out[-1]
    ones = np.ones((len(bias), 1), np.float32)
    for t in range(longest - 1, -1, -1):
        n = int(alive[t])
        if n > len(h):
            h = np.concatenate([h, np.zeros((n - len(h), size), np.float32)])
        h, _ = _step(model.x[1], model.u[1], model.v[1], text[t, :n], h)
        scores = ahead[t] @ left
        scores += h @ right
        scores += bias
        np.exp(scores, out=scores)  # states lie between -1 and 1, so scores are bounded by the weights
        scores /= scores @ ones
        yield t, n, scores


def _windows(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and length of every window, sorted by falling length."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    doc = np.repeat(np.arange(len(size)), count)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][doc] + place * WINDOW
    length = np.minimum(WINDOW, offsets[1:][doc] - start)
    order = np.argsort(-length, kind="stable")
    return doc[order], start[order], length[order]


def document_probabilities(model: Model, texts: pa.Array) -> np.ndarray:
    """Mean label probabilities (documents, labels) over all bytes; zeros for empty texts."""
    data, offsets = raw_bytes(texts)
    total = np.zeros((len(texts), len(model.labels)))
    doc, start, length = _windows(offsets)
    for at in range(0, len(doc), BATCH):
        part = slice(at, at + BATCH)
        sums = np.zeros((len(doc[part]), len(model.labels)), np.float32)
        for _, n, prob in position_probabilities(model, data, start[part], length[part]):
            sums[:n] += prob
        np.add.at(total, doc[part], sums)
    return total / np.maximum(np.diff(offsets), 1)[:, None]


def position_labels(model: Model, text: str) -> list[tuple[int, int, str]]:
    """Runs ``start, end, label`` of a text's bytes with the same most probable label."""
    data, offsets = raw_bytes(pa.array([text], pa.string()))
    best = np.zeros(len(data), dtype=np.int64)
    _, start, length = _windows(offsets)
    for at in range(0, len(start), BATCH):
        part = slice(at, at + BATCH)
        for t, n, prob in position_probabilities(model, data, start[part], length[part]):
            best[start[part][:n] + t] = prob.argmax(axis=1)
    edges = np.flatnonzero(np.diff(best)) + 1
    bounds = [0, *edges.tolist(), len(best)] if len(best) else [0]
    return [(a, b, model.labels[best[a]]) for a, b in zip(bounds, bounds[1:])]


def has_letter(texts: pa.Array) -> np.ndarray:
    """Which texts hold a letter of any script."""
    data, offsets = raw_bytes(texts)
    count = np.concatenate(([0], np.cumsum(_LETTERS[data])))
    found = np.diff(count[offsets]) > 0
    for i in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[i] = any(c.isalpha() for c in texts[int(i)].as_py())
    return found


def held_out(doc_id: str):
    """Whether a document is kept from training: crc32 of its id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def _thinned(known: DataFrame) -> DataFrame:
    """Rows whose ``draw`` is small for their label: some SPARE x SAMPLE_PER_LABEL ids of each, whatever the input.

    They hold the SAMPLE_PER_LABEL smallest draws (but for a chance below 1e-100), so the sample stays as it is, and the task
    that orders a label's rows meets no more ids when the input grows. Labels of fewer ids keep all rows: ids are counted, not
    rows, because a label may consist of copies. The counts are small sketches per label, merged from all tasks.
    """
    counts = known.groupBy("lang").agg(F.approx_count_distinct("id").alias("_ids"))  # one row per label
    share = F.lit(float(SPARE * SAMPLE_PER_LABEL)) / F.col("_ids")
    small = F.col("draw") / F.lit(2.0**64) + 0.5 <= share  # draws spread evenly over the 64-bit integers
    return known.join(counts, "lang").where((share >= 1) | small).drop("_ids")


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Train on a sample of labelled rows that are not held out.

    The driver gets SAMPLE_PER_LABEL rows of each label at most, those with the smallest hash of id and text,
    and of each EXCERPTS pieces of EXCERPT_CHARS characters. Training costs the same for every
    input size. Without labelled rows the model knows no label.
    """
    known = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    known = known.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("id").isNotNull())
    known = _thinned(known.where(~held_out("id")).withColumn("draw", F.xxhash64("id", "text")))
    room = F.greatest(F.char_length("text") - EXCERPT_CHARS, F.lit(0)) + 1
    excerpts = F.array(
        *[F.substring("text", (F.pmod(F.xxhash64("id", F.lit(k)), room) + 1).cast("int"), F.lit(EXCERPT_CHARS))
          for k in range(EXCERPTS)]
    )
    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "id"))
    rows = (
        known.select("lang", "draw", "id", excerpts.alias("excerpts"))
        .withColumn("place", first)
        .where(F.col("place") <= SAMPLE_PER_LABEL)
        .orderBy("lang", "place")
        .select("lang", "excerpts")
        .collect()
    )
    pairs = [(e.encode(), r["lang"]) for r in rows for e in r["excerpts"]]
    return train([t for t, _ in pairs], [y for _, y in pairs])


def _predictions(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Label and score of each text; ``und`` and 0 without a letter."""
    letter = has_letter(texts)
    if model.labels:
        prob = document_probabilities(model, texts)
        names = np.array(model.labels, dtype=object)[prob.argmax(axis=1)]
        score = prob.max(axis=1).clip(0, 1)
    else:
        names, score = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
    names[~letter], score[~letter] = UNKNOWN, 0.0
    return names, score


def keep_identified(docs: DataFrame, model: Model, least: float, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a letter and a label with at least this score.

    A model without labels rejects letterless texts only.
    """

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                texts = part.column(text)
                keep = has_letter(texts)
                if model.labels:
                    keep &= _predictions(model, texts)[1] >= least
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(kept, docs.schema)


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, lang_pred, score``.

    ``score`` is the mean probability of the label over all bytes. Null, empty and letterless texts
    are ``und`` with score 0, as is every text if the model knows no label. Rows are judged one by one, so repeated
    rows and null ids change nothing, and no other column is read.
    """

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                names, score = _predictions(model, part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                    ["doc_id", "lang_pred", "score"],
                )

    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(labelled, f"doc_id {kind}, lang_pred string, score double")
