"""Approximate nearest neighbours on robust-pruned directed graphs, one graph for each shard.

Distinct vectors are dealt by hash into shards of some SHARD_ROWS. A task builds the graph
of its shard: points enter in blocks, a greedy beam search from the entry point proposes
neighbours, and pruning keeps a candidate unless one already kept is nearer to it by the
factor ``alpha``. Every query is searched in every shard by the same beam, so the work
per query is shards x beam; the nearest of all shards are merged.

The measure is the inner product. Each shard is lifted by one coordinate so that all its
vectors have the same length; there, the nearest by distance is the largest by inner product.
Scores are computed in double precision on the original vectors.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewheel.llm.joins import store

SHARD_ROWS = 2048
DEGREE = 32
BUILD_BEAM = 48
SEARCH_BEAM = 128
ALPHA = 1.2
BLOCK = 128
QUERY_BLOCK = 512
SHARDS_AT_ONCE = 16


def _distances(points: np.ndarray, which: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Squared distances of targets (B, d) to points[which] (B, n); all points have the same length.

    ``which`` may hold -1 for no point: infinitely far.
    """
    near = 2 * (points[0] @ points[0]) - 2 * (points[which] @ targets[:, :, None])[:, :, 0]
    near[which < 0] = np.inf
    return near


def beam_search(points: np.ndarray, graph: np.ndarray, entry: int, targets: np.ndarray, beam: int):
    """Indices and distances (B, beam) of the nearest points found, nearest first, and all points expanded (B, steps)."""
    rows = np.arange(len(targets))[:, None]
    found = np.full((len(targets), beam), -1)
    found[:, 0] = entry
    far = _distances(points, found, targets)
    done = found < 0
    seen = np.zeros((len(targets), len(points)), dtype=bool)
    seen[:, entry] = True
    path = []
    while not done.all():
        pick = np.argmin(np.where(done, np.inf, far), axis=1)[:, None]  # the nearest not yet expanded
        idle = done[rows, pick]
        node = np.where(idle, -1, found[rows, pick])
        path.append(node[:, 0])
        done[rows, pick] = True
        next_ = np.where(node >= 0, graph[node[:, 0]], -1)
        fresh = (next_ >= 0) & ~seen[rows, np.maximum(next_, 0)]
        next_ = np.where(fresh, next_, -1)
        seen[np.broadcast_to(rows, next_.shape)[fresh], next_[fresh]] = True
        all_found = np.concatenate([found, next_], axis=1)
        all_far = np.concatenate([far, _distances(points, next_, targets)], axis=1)
        all_done = np.concatenate([done, next_ < 0], axis=1)
        order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        found, far, done = all_found[rows, order], all_far[rows, order], all_done[rows, order]
    return found, far, np.stack(path, axis=1)


def robust_prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each point own[b], up to ``degree`` of candidates[b] (-1: none) that point in different directions."""
    candidates = np.where(candidates == own[:, None], -1, candidates)
    order = np.sort(candidates, axis=1)
    repeated = np.zeros_like(order, dtype=bool)
    repeated[:, 1:] = order[:, 1:] == order[:, :-1]
    candidates = np.where(repeated, -1, order)
    far = _distances(points, candidates, points[own])
    vectors = points[candidates]
    between = 2 * (points[0] @ points[0]) - 2 * (vectors @ vectors.transpose(0, 2, 1))
    kept = np.full((len(own), degree), -1)
    rows = np.arange(len(own))
    for k in range(degree):
        best = np.argmin(far, axis=1)
        alive = np.isfinite(far[rows, best])
        if not alive.any():
            break
        chosen = np.where(alive, candidates[rows, best], -1)
        kept[:, k] = chosen
        far[(alpha * between[rows, best] <= far) & alive[:, None]] = np.inf
        far[rows, best] = np.inf
    return kept


def build_graph(
    points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 0
) -> tuple[np.ndarray, int]:
    """Out-neighbours (n, degree; -1 for none) and the entry point, the one nearest to the mean."""
    n = len(points)
    rng = np.random.default_rng(seed)
    entry = int(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1)))
    graph = np.full((n, degree), -1)
    if n > 1:
        start = min(degree // 2, n - 1)
        graph[:, :start] = (np.arange(n)[:, None] + rng.integers(1, n, (n, start))) % n
    for a in (1.0, alpha):
        order = rng.permutation(n)
        for at in range(0, n, BLOCK):
            own = order[at : at + BLOCK]
            found, _, path = beam_search(points, graph, entry, points[own], beam)
            graph[own] = robust_prune(points, own, np.concatenate([found, path, graph[own]], axis=1), degree, a)
            _add_back(points, graph, own, a)
    return graph, entry


def _add_back(points: np.ndarray, graph: np.ndarray, own: np.ndarray, alpha: float) -> None:
    """Let the new neighbours of ``own`` point back; a full list is pruned again."""
    degree = graph.shape[1]
    source = np.repeat(own, degree)
    target = graph[own].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first = np.unique(target, return_index=True)
    place = np.arange(len(target)) - np.repeat(first, np.diff([*first, len(target)]))
    wide = np.full((len(nodes), int(place.max(initial=-1)) + 1), -1)
    wide[np.searchsorted(nodes, target), place] = source
    for at in range(0, len(nodes), BLOCK):
        part = slice(at, at + BLOCK)
        both = np.concatenate([graph[nodes[part]], wide[part]], axis=1)
        graph[nodes[part]] = robust_prune(points, nodes[part], both, degree, alpha)


def _lifted(vectors: np.ndarray) -> np.ndarray:
    """Vectors with one more coordinate that gives all the length of the longest."""
    size = np.einsum("nd,nd->n", vectors, vectors)
    top = float(size.max())
    return np.concatenate([vectors, np.sqrt(np.maximum(top - size, 0))[:, None]], axis=1)


def _index_shard(shard: pa.Table) -> pa.Table:
    """One row with the keys, vectors and graph of a shard as raw arrays."""
    vectors = _stacked(shard.column("vector"))
    graph, entry = build_graph(_lifted(vectors).astype(np.float32))
    keys = shard.column("vector_key").to_numpy()
    raw = [keys.astype(np.int64), vectors, graph.astype(np.int32)]
    return pa.table(
        {
            "shard": [shard.column("shard")[0].as_py()],
            "keys": pa.array([raw[0].tobytes()], pa.binary()),
            "vectors": pa.array([raw[1].tobytes()], pa.binary()),
            "graph": pa.array([raw[2].tobytes()], pa.binary()),
            "entry": [entry],
        },
        schema=_INDEX,
    )


_INDEX = pa.schema(
    [("shard", pa.int32()), ("keys", pa.binary()), ("vectors", pa.binary()), ("graph", pa.binary()), ("entry", pa.int32())]
)
_FOUND = pa.schema([("query_id", pa.int64()), ("vector_key", pa.int64()), ("score", pa.float64())])


def _search_shards(k: int, beam: int, queries: pa.Table, index: pa.Table) -> pa.Table:
    """The k best vectors of some shards for each query of one block."""
    if not queries.num_rows or not index.num_rows:
        return _FOUND.empty_table()
    asked = _stacked(queries.column("vector"))
    lifted = np.concatenate([asked, np.zeros((len(asked), 1))], axis=1)
    lifted = (lifted / np.linalg.norm(asked, axis=1)[:, None]).astype(np.float32)  # the order is the same
    best_key = np.full((len(asked), 0), -1, dtype=np.int64)
    best = np.zeros((len(asked), 0))
    for row in index.select(["keys", "vectors", "graph", "entry"]).to_pylist():
        ids = np.frombuffer(row["keys"], np.int64)
        vectors = np.frombuffer(row["vectors"], np.float64).reshape(len(ids), -1)
        graph = np.frombuffer(row["graph"], np.int32).reshape(len(ids), -1)
        points = _lifted(vectors).astype(np.float32)
        keys, scores = [], []
        for at in range(0, len(asked), BLOCK):
            part = slice(at, at + BLOCK)
            found, _, _ = beam_search(points, graph, row["entry"], lifted[part], min(max(beam, k), len(points)))
            score = np.einsum("bnd,bd->bn", vectors[found], asked[part])
            keys.append(np.where(found < 0, -1, ids[found]))
            scores.append(np.where(found < 0, -np.inf, score))
        best_key = np.concatenate([best_key, np.concatenate(keys)], axis=1)
        best = np.concatenate([best, np.concatenate(scores)], axis=1)
        order = np.lexsort((best_key, -best))[:, :k]
        best_key, best = np.take_along_axis(best_key, order, axis=1), np.take_along_axis(best, order, axis=1)
    good = best_key.ravel() >= 0
    rows = np.repeat(np.arange(len(asked)), best.shape[1])[good]
    query = queries.column("query_id").take(pa.array(rows))
    found = {"query_id": query, "vector_key": best_key.ravel()[good], "score": best.ravel()[good]}
    return pa.table(found, schema=_FOUND)


def _stacked(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1).astype(np.float64)


def nearest(
    table: DataFrame,
    is_query,
    k: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    beam: int = SEARCH_BEAM,
) -> DataFrame:
    """The k rows with the largest inner product for every row where ``is_query`` holds: ``query_id, rank, vec_id, score``.

    Equal vectors are indexed once, so that copies cannot wall off a graph; the copies
    join in at the end, and ties go to the smaller id. A query's own row is left out.
    Vectors that are null, zero, or hold null or non-finite components, and rows with a
    null id, take no part; neither do vectors of another length than most. Rows that repeat an id with an equal vector
    count once. Queries whose list is shorter than k have fewer rows. Runs jobs while it builds the result.
    """
    given = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("e"), is_query.alias("ask"))
    fine = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = given.where(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & fine)
    usable = usable.where(F.exists("e", lambda x: x != 0)).withColumn("vector", F.col("e").cast("array<double>"))
    lengths = usable.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    width = lengths[0]["n"] if lengths else 0
    usable = usable.where(F.size("vector") == width)
    distinct = (
        usable.groupBy("vector")
        .agg(F.min("vec_id").alias("vector_key"), F.bool_or(F.coalesce("ask", F.lit(False))).alias("ask"))
        .withColumn("draw", F.xxhash64("vector_key"))
    )
    distinct = store(distinct, "vectors")
    shards = max(1, -(-distinct.count() // shard_rows))
    # Copies of a vector, the k + 1 smallest ids of each: no list can need more.
    copies = store(
        usable.select("vector", "vec_id").distinct().join(distinct.select("vector", "vector_key"), "vector")
        .select("vector_key", "vec_id", "vector"), "copies"
    )
    listed = _smallest(copies.select("vector_key", "vec_id"), "vector_key", "vec_id", k + 1)
    queries = usable.where("ask").select("vec_id", "vector").distinct()
    dealt = distinct.select("vector_key", "vector", F.pmod("draw", F.lit(shards)).cast("int").alias("shard"))
    index = dealt.groupBy("shard").applyInArrow(
        _index_shard, "shard int, keys binary, vectors binary, graph binary, entry int"
    )
    index = store(index, "graphs")
    # One search for each distinct query vector in every shard; a group meets one block of queries and some shards, of which
    # it keeps the best.
    groups = -(-shards // SHARDS_AT_ONCE)
    asked = distinct.where("ask").select(F.col("vector_key").alias("query_id"), "vector", "draw")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("draw"), F.lit(blocks)).cast("int"))
    asked = asked.select("query_id", "vector", "block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("some"))
    spread = index.withColumn("some", F.pmod("shard", F.lit(groups)).cast("int"))
    spread = spread.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = (
        asked.groupBy("some", "block")
        .cogroup(spread.groupBy("some", "block"))
        .applyInArrow(partial(_search_shards, k + 1, beam), "query_id long, vector_key long, score double")
    )
    best = _best(found.select(F.col("query_id").alias("g"), "vector_key", "score"), k + 1, "vector_key")
    merged = best.join(listed, "vector_key").select("g", "vec_id", "score")
    merged = store(_best(merged, k + 1, "vec_id"), "found")
    owners = queries.join(distinct.select("vector", "vector_key"), "vector").select(
        F.col("vec_id").alias("query_id"), F.col("vector_key").alias("g")
    )
    lists = merged.groupBy("g").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("l"))
    ranked = owners.join(lists, "g").select(
        "query_id",
        F.posexplode(F.slice(F.filter("l", lambda x: x.vec_id != F.col("query_id")), 1, k)).alias("at", "hit"),
    )
    return ranked.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.s")).alias("score"),
    )


def _smallest(df: DataFrame, group: str, value: str, n: int) -> DataFrame:
    order = Window.partitionBy(group).orderBy(value)
    return df.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n).drop("place")


def _best(df: DataFrame, n: int, tie: str) -> DataFrame:
    """The n highest scores of each ``g``; Spark cuts the lists before and after the shuffle."""
    order = Window.partitionBy("g").orderBy(F.desc("score"), tie)
    return df.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n).drop("place")
