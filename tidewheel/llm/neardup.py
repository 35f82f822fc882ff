"""MinHash near-duplicate classes by a multi-index Hamming join on b-bit signatures.

A document's signature has COORDINATES minhash values of 16 bits each; the distance of
two signatures is the number of coordinates that differ. The coordinates are cut into
chunks. If two signatures differ in at most ``max_distance`` places, the pigeonhole
principle says that some chunk has at most ``max_distance // chunks`` errors, so every
way of leaving out that many coordinates of every chunk is enumerated as a bucket key:
all pairs within the distance meet in some bucket, none is left to chance.

The distance limit itself lies 4.6 standard deviations above the mean distance of a pair
that just reaches the similarity, and whatever passes is confirmed on the full shingle sets.

No group is expanded to rows of pairs. Texts with equal shingle sets are one node. In
each bucket the members meet one pivot first, drawn by hash, and of the pivots that a
document met only the nearest is confirmed; large groups fall together in this way. What
is left are buckets that hold several components. Their members are compared inside a
task, block against block, and only what hangs together is returned: clusters of components
with members within the distance. In each cluster the documents outside its largest
component are then held against all others on their full sets, again block against block;
at most one link for each document and component leaves the task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.components import components
from tidewheel.llm.joins import keep_ids, store, stored_ids
from tidewheel.llm.textops import mix, slices, split_words, window_hashes, word_hashes

COORDINATES = 64
CHUNK = 4
PIVOT_ROUNDS = 2
BUCKET_BLOCK = 1024  # signatures compared with as many others in one task
SET_BLOCK = 256  # documents whose full sets are held against as many others

_rng = np.random.default_rng(0xD1CE)
_XOR = _rng.integers(0, 1 << 32, COORDINATES, dtype=np.uint32)
_ODD = _rng.integers(0, 1 << 31, COORDINATES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def distance_limit(percent: int) -> int:
    """Signature distance that a pair of this similarity exceeds with a chance near 1e-5."""
    differ = 1 - percent / 100
    return min(COORDINATES, int(COORDINATES * differ + 4.6 * math.sqrt(COORDINATES * differ * (1 - differ))))


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; a shorter text is one shingle, an empty one none."""
    words = split_words(texts, lower=True)
    hashes = word_hashes(words)
    count = words.counts
    full = np.maximum(count - size + 1, 0)
    begin = np.repeat(words.first[:-1] - np.concatenate(([0], np.cumsum(full)[:-1])), full) + np.arange(full.sum())
    shingles = window_hashes(hashes, begin, size)
    at = np.concatenate(([0], np.cumsum(full)))
    for d, n in enumerate(count):
        if n >= size:
            yield np.unique(shingles[at[d] : at[d + 1]])
        elif n:
            yield window_hashes(hashes, words.first[d : d + 1], int(n)) ^ np.uint64(n)
        else:
            yield np.zeros(0, dtype=np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 16-bit minhash values per non-empty set."""
    at = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1])).astype(np.int64)
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), COORDINATES), dtype=np.uint16)
    for k in range(COORDINATES):
        low = np.minimum.reduceat((values ^ _XOR[k]) * _ODD[k], at)
        out[:, k] = (low * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return out


def _profiles(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets = list(shingle_sets(part.column("text"), size))
            full = [s for s in sets if len(s)]
            rows = iter(signatures(full)) if full else iter(())
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            sig = [next(rows).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digest, pa.binary()),
                    pa.array(sig, pa.binary()),
                ],
                ["doc_id", "n_shingles", "digest", "sig"],
            )


def _set_rows(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            sets = [s.tobytes() for s in shingle_sets(part.column("text"), size)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "members"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(len(column), COORDINATES)


def _bucket_keys(errors: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept = list(combinations(range(CHUNK), max(CHUNK - errors, 1)))
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = _matrix(batch.column("sig")).astype(np.uint64)
        ids = batch.column("doc_id")
        for start in range(0, COORDINATES, CHUNK):
            for which, places in enumerate(kept):
                key = np.full(len(sig), start * 100 + which, dtype=np.uint64)
                for p in places:
                    key = mix(key) + sig[:, start + p]
                yield pa.RecordBatch.from_arrays([pa.array(mix(key).view(np.int64)), ids], ["key", "doc_id"])


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            far = (_matrix(batch.column("sig_a")) != _matrix(batch.column("sig_b"))).sum(axis=1)
            columns = [batch.column("a"), batch.column("b"), pa.array(far.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "distance"])


def _confirm(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = np.zeros(batch.num_rows, dtype=bool)
        for i, (x, y) in enumerate(zip(batch.column("set_a"), batch.column("set_b"), strict=True)):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = np.intersect1d(x, y, assume_unique=True).size
            keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _near(pairs: DataFrame, sigs: DataFrame, limit: int) -> DataFrame:
    """Pairs ``a, b`` within the signature distance, with that distance."""
    for side in "ab":
        named = sigs.select(F.col("doc_id").alias(side), F.col("sig").alias(f"sig_{side}"))
        pairs = pairs.join(named, side)
    found = pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(_distances, "a long, b long, distance int")
    return found.where(F.col("distance") <= limit)


def _confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets reach the similarity."""
    pairs = store(pairs.select("a", "b"), "pairs")
    ids = stored_ids(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), "doc_id")
    sets = store(
        keep_ids(docs, ids, "doc_id").mapInArrow(partial(_set_rows, size), "doc_id long, members binary"), "sets"
    )
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("doc_id").alias(side), F.col("members").alias(f"set_{side}")), side)
    checked = pairs.select("a", "b", "set_a", "set_b").mapInArrow(partial(_confirm, percent), "a long, b long")
    return store(checked, "links")


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of consecutive rows with equal keys, of a partition sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for k in keys:
            values = batch.column(k).to_numpy()
            change |= values[1:] != values[:-1]
        if held and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for at, end in zip(bounds, bounds[1:]):
            held.append(batch.slice(at, end - at))
            if end < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _near_components(limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each cell of a bucket: pairs of components that hang together by members within the distance."""
    for cell in _runs(batches, ["key", "i", "j"]):
        component = cell.column("component").to_numpy()
        if (component == component[0]).all():
            continue
        sig = _matrix(cell.column("sig").combine_chunks())
        far = np.zeros((len(sig), len(sig)), dtype=np.int16)
        for k in range(COORDINATES):
            far += sig[:, k, None] != sig[None, :, k]
        near = (far <= limit) | (component[:, None] == component[None, :])
        label, before = component.copy(), None
        while before is None or (label != before).any():
            before = label
            label = np.where(near, before[None, :], np.iinfo(np.int64).max).min(axis=1)
        pairs = np.unique(np.stack([component, label])[:, component != label], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])


def _block_links(percent: int, left: pa.Table, right: pa.Table) -> pa.Table:
    """Links between documents of two blocks, one for each left document and right component."""
    sets = [np.frombuffer(m.as_buffer(), np.uint64) for m in right.column("members")]
    sizes = np.array([len(m) for m in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    shingle = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    order = np.argsort(shingle, kind="stable")
    shingle, owner = shingle[order], owner[order]
    ids, component = right.column("doc_id").to_numpy(), right.column("component").to_numpy()
    found: list[tuple[int, int]] = []
    for doc, own, members in zip(left.column("doc_id"), left.column("component"), left.column("members")):
        members = np.frombuffer(members.as_buffer(), np.uint64)
        first = np.searchsorted(shingle, members, side="left")
        count = np.searchsorted(shingle, members, side="right") - first
        at = np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        both = np.bincount(owner[at], minlength=len(sets))
        hit = np.flatnonzero(
            (100 * both >= percent * (sizes + len(members) - both)) & (component != own.as_py()) & (sizes > 0)
        )
        for k in hit[np.unique(component[hit], return_index=True)[1]]:
            found.append((doc.as_py(), int(ids[k])))
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _links_across(
    buckets: DataFrame, sigs: DataFrame, docs: DataFrame, size: int, percent: int, limit: int
) -> DataFrame:
    """Confirmed links between different components that meet in a bucket."""
    blocks = F.ceil(F.count("*") / BUCKET_BLOCK).cast("int")
    cells = (
        buckets.join(buckets.groupBy("key").agg(blocks.alias("blocks")), "key")
        .join(sigs, "doc_id")
        .withColumn("mine", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "component", "sig")
    )
    together = cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    edges = store(together.mapInArrow(partial(_near_components, limit), "a long, b long").distinct(), "near")
    clusters = components(edges, "a", "b").toDF("component", "cluster")
    members = store(
        buckets.select("doc_id", "component").distinct().join(clusters, "component"), "clusters"
    )  # every document of these components that is in a mixed bucket; no other can be within the distance
    sizes = members.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("cluster").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"),
        F.ceil(F.sum("n") / SET_BLOCK).cast("int").alias("all_blocks"),
        F.ceil((F.sum("n") - F.max("n")) / SET_BLOCK).cast("int").alias("rest_blocks"),
    )
    ids = stored_ids(members, "doc_id")
    sets = keep_ids(docs, ids, "doc_id").mapInArrow(partial(_set_rows, size), "doc_id long, members binary")
    placed = store(members.join(main, "cluster").join(sets, "doc_id"), "sets")
    dealt = F.xxhash64("doc_id")
    right = placed.withColumn("i", F.pmod(dealt, F.col("all_blocks")).cast("int")).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.col("rest_blocks") - 1))
    )
    left = (
        placed.where("component <> main")
        .withColumn("j", F.pmod(dealt, F.col("rest_blocks")).cast("int"))
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("all_blocks") - 1)))
    )
    columns = ["cluster", "i", "j", "doc_id", "component", "members"]
    return (
        left.select(columns)
        .groupBy("cluster", "i", "j")
        .cogroup(right.select(columns).groupBy("cluster", "i", "j"))
        .applyInArrow(partial(_block_links, percent), "a long, b long")
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """Return ``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a document's set are its
    distinct ``shingle``-word sequences (a shorter text is one sequence). Documents whose
    sets have 100 * intersection >= percent * union are linked; ``component_id`` is the
    smallest id reachable and ``kept`` marks that document. Null, empty and blank texts
    have no shingles and stand alone. A null id stands alone with a null class and is
    kept. Rows repeating an id belong to one class, whatever their texts. Other columns
    of ``docs`` are not touched. Runs jobs while it builds the result.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    limit = distance_limit(percent)
    errors = limit // (COORDINATES // CHUNK)
    profiles = store(
        docs.mapInArrow(partial(_profiles, shingle), "doc_id long, n_shingles long, digest binary, sig binary"),
        "profiles",
    )
    usable = profiles.where("doc_id IS NOT NULL AND sig IS NOT NULL")
    nodes = store(
        usable.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig")), "nodes"
    )
    copies = (
        usable.join(nodes.select("digest", F.col("doc_id").alias("node")), "digest")
        .where("doc_id <> node")
        .select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    sigs = nodes.groupBy("doc_id").agg(F.first("sig").alias("sig"))
    keys = sigs.mapInArrow(partial(_bucket_keys, errors), "key long, doc_id long")
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    buckets = store(keys.join(shared, "key"), "buckets").withColumn("component", F.col("doc_id"))

    links = None
    for turn in range(PIVOT_ROUNDS):
        draw = F.xxhash64(F.lit(turn), "key", "doc_id")
        pivots = buckets.groupBy("key").agg(F.min_by(F.struct("doc_id", "component"), draw).alias("pivot"))
        met = (
            buckets.join(pivots, "key")
            .where("component <> pivot.component")
            .select(F.col("doc_id").alias("a"), F.col("pivot.doc_id").alias("b"))
            .distinct()
        )
        nearest = _near(met, sigs, limit).groupBy("a").agg(F.min_by("b", F.struct("distance", "b")).alias("b"))
        fresh = _confirmed(nearest, docs, shingle, percent)
        links = fresh if links is None else links.union(fresh)
        buckets = _unsettled(buckets, components(links, "a", "b"))
    links = links.union(_links_across(buckets, sigs, docs, shingle, percent, limit))

    found = components(links.select("a", "b").union(copies), "a", "b")
    return (
        profiles.select("doc_id", "n_shingles")
        .join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component", "doc_id").alias("component_id"),
            F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )


def _unsettled(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """Bucket members with their components, of buckets that hold at least two."""
    now = (
        buckets.drop("component")
        .join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("key", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    )
    mixed = now.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    return store(now.join(mixed.select("key"), "key"), "buckets")
