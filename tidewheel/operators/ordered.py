"""Ordered work (lag, ids, running sums, ntile, rank) without oversized groups.

Window functions put a whole group in one task. Groups up to ``max_group_rows``
take that road: one shuffle on the keys. Larger ones are range-partitioned on
(keys, order) instead, so that a group spreads over many *slices*, each stored as a bucket
of its own: rows move once. What a slice has to know about its neighbours is one row per slice, joined back by broadcast.
Every row is kept and results equal the plain window's.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialise, materialise_bucketed

# Rows of one group that a single task may sort (it can spill) and walk through.
MAX_GROUP_ROWS = 4_000_000

SLICE = "_slice"
POS = "_pos"
_ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row index in its low 33 bits


def same_values(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Null-safe equality of two column lists."""
    return reduce(lambda a, b: a & b, [l.eqNullSafe(r) for l, r in zip(left, right)])


def split_hot(df: DataFrame, keys: Sequence[str], max_group_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Separate rows of groups above the limit: ``(ordinary, hot or None)``.

    At most rows / max_group_rows keys can be hot. Their stored list carries its
    true size, so Spark broadcasts it only when it is small. Runs jobs: the groups are counted
    once, and if some are hot the rows are stored once, from where both parts are read.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_group_rows)
    hot = materialise(counted.select(*keys), "hotkeys")
    if hot.isEmpty():
        return df, None
    df = materialise(df, "rows")
    on = same_values([df[k] for k in keys], [hot[k] for k in keys])
    return df.join(hot, on, "left_anti"), df.join(hot, on, "left_semi")


def slice_in_order(df: DataFrame, order: Sequence[Column], slices: int | None = None) -> DataFrame:
    """Store ``df`` in total order, each row tagged with its slice and its position in it.

    The one shuffle of the rows: the task that sorts a slice stores it as a bucket of its own number, so windows and totals
    by slice need no second one. Where two slices share a bucket, one task reads both.
    """
    buckets = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged = (
        df.repartitionByRange(*([slices] if slices else []), *order)
        .sortWithinPartitions(*order)
        .select(
            "*",
            F.spark_partition_id().alias(SLICE),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias(POS),
        )
    )
    return materialise_bucketed(tagged, SLICE, buckets, "slices", dealt=True)


def _totals_before(sliced: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
    """Per slice, the totals of all earlier slices: one row per slice, hence broadcast."""
    per_slice = sliced.groupBy(SLICE).agg(*[e.alias(name) for name, e in sums.items()])
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in sums]
    return F.broadcast(per_slice.select(SLICE, *before))


def dense_id(df: DataFrame, order: Sequence[str | Column], name: str, slices: int | None = None) -> DataFrame:
    """Add consecutive ids 1..n in the given order (which must be unique)."""
    sliced = slice_in_order(df, [_column(o) for o in order], slices)
    before = _totals_before(sliced, {"_before": F.count(F.lit(1))})
    return sliced.join(before, SLICE).select(
        *[F.col(c) for c in df.columns], (F.col(POS) + F.col("_before") + 1).alias(name)
    )


def dim_id(df: DataFrame, order: Sequence[str | Column], name: str, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """:func:`dense_id` for a set of keys that is mostly small; it is stored and counted first."""
    stored = materialise(df, "keys")
    if stored.count() > max_group_rows:
        return dense_id(stored, order, name)
    return stored.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))


def running_totals(
    df: DataFrame,
    order: Sequence[str | Column],
    sums: Mapping[str, str],
    totals: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Add inclusive running sums over the total order (which must be unique).

    ``sums`` maps a new column to its source, ``totals`` likewise for sums over all
    rows and ``following`` for values of the next row (null on the last).
    """
    totals, following = dict(totals or {}), dict(following or {})
    sliced = slice_in_order(df, [_column(o) for o in order], slices)
    in_slice = Window.partitionBy(SLICE).orderBy(POS)
    so_far = in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    # What a slice must know of the others: one row per slice, hence the broadcast.
    across = Window.orderBy(SLICE)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per_slice = sliced.groupBy(SLICE).agg(
        *[F.sum(c).alias(f"_s_{n}") for n, c in sums.items()],
        *[F.sum(c).alias(f"_t_{n}") for n, c in totals.items()],
        *[F.min_by(c, POS).alias(f"_f_{n}") for n, c in following.items()],
    )
    edges = per_slice.select(
        SLICE,
        *[F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_s_{n}") for n in sums],
        *[F.sum(f"_t_{n}").over(everything).alias(n) for n in totals],
        *[F.lead(f"_f_{n}").over(across).alias(f"_f_{n}") for n in following],
    )
    local = sliced.select(
        "*",
        *[F.sum(c).over(so_far).alias(f"_local_{n}") for n, c in sums.items()],
        *[F.lead(c).over(in_slice).alias(f"_next_{n}") for n, c in following.items()],
    )
    return local.join(F.broadcast(edges), SLICE).select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"_local_{n}") + F.col(f"_s_{n}")).alias(n) for n in sums],
        *totals,
        *[F.coalesce(f"_next_{n}", f"_f_{n}").alias(n) for n in following],
    )


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add values of the previous / following row of the same group (null at its ends).

    ``previous`` and ``following`` map a new column to the column it is taken from.
    """
    previous, following = dict(previous or {}), dict(following or {})
    ordinary, hot = split_hot(df, keys, max_group_rows)
    in_group = Window.partitionBy(*keys).orderBy(*order)
    plain = ordinary.select(
        "*",
        *[F.lag(c).over(in_group).alias(n) for n, c in previous.items()],
        *[F.lead(c).over(in_group).alias(n) for n, c in following.items()],
    )
    if hot is None:
        return plain

    sliced, before, after = _sliced_neighbours(hot, keys, order, [*previous.values(), *following.values()])
    own = [F.col(k) for k in keys]
    same_before = same_values([before[k] for k in keys], own)
    same_after = same_values([after[k] for k in keys], own)
    stitched = sliced.select(
        *df.columns,
        *[F.when(same_before, before[c]).alias(n) for n, c in previous.items()],
        *[F.when(same_after, after[c]).alias(n) for n, c in following.items()],
    )
    return plain.unionByName(stitched)


def _sliced_neighbours(hot, keys, order, columns):
    """Sliced rows with the row before and after each as structs, across slice edges too."""
    sliced = slice_in_order(hot, [F.col(c) for c in [*keys, *order]])
    row = F.struct(*dict.fromkeys([*keys, *columns]))
    within = Window.partitionBy(SLICE).orderBy(POS)
    across = Window.orderBy(SLICE)  # one row per slice
    edges = sliced.groupBy(SLICE).agg(F.min_by(row, POS).alias("_first"), F.max_by(row, POS).alias("_last"))
    edges = edges.select(
        SLICE, F.lag("_last").over(across).alias("_edge_before"), F.lead("_first").over(across).alias("_edge_after")
    )
    sliced = (
        sliced.select("*", F.lag(row).over(within).alias("_lag"), F.lead(row).over(within).alias("_lead"))
        .join(F.broadcast(edges), SLICE)
        .select(
            "*",
            F.coalesce("_lag", "_edge_before").alias("_before"),
            F.coalesce("_lead", "_edge_after").alias("_after"),
        )
    )
    return sliced, F.col("_before"), F.col("_after")


def with_ntile(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    buckets: int,
    name: str,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add NTILE(buckets) per group; ``order`` should end in a unique tie-break."""
    ordinary, hot = split_hot(df, keys, max_group_rows)
    in_group = Window.partitionBy(*keys).orderBy(*order)
    plain = ordinary.withColumn(name, F.ntile(buckets).over(in_group))
    if hot is None:
        return plain

    numbered = dense_id(hot, [*keys, *order], "_id")
    # One row per hot group, at most rows / max_group_rows of them.
    groups = numbered.groupBy(*keys).agg(F.min("_id").alias("_start"), F.count(F.lit(1)).alias("_size"))
    groups = groups.select(*[F.col(k).alias(f"_g_{k}") for k in keys], "_start", "_size")
    on = same_values([F.col(k) for k in keys], [F.col(f"_g_{k}") for k in keys])
    rank0 = F.col("_id") - F.col("_start")
    base = F.expr(f"_size div {buckets}")
    larger = F.col("_size") % buckets  # the first buckets hold one row more
    tile = F.when(
        rank0 < larger * (base + 1), F.floor(rank0 / (base + 1)) + 1
    ).otherwise(larger + F.floor((rank0 - larger * (base + 1)) / F.greatest(base, F.lit(1))) + 1)
    tiled = numbered.join(F.broadcast(groups), on).select(*df.columns, tile.cast("int").alias(name))
    return plain.unionByName(tiled)


def run_spans(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    state: Column,
    calendar: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Maximal runs of rows with an equal ``state`` in each group.

    Returns keys, ``state``, ``run_start``, ``run_end`` (first order column) and
    ``run_rows``. All rows are numbered before any are filtered, so a run ends where
    another state comes between. ``calendar=True`` also ends it at a missing day.
    """
    at = order[0]
    rows = df.select(*dict.fromkeys([*keys, *order]), state.alias("state"))
    ordinary, hot = split_hot(rows, keys, max_group_rows)

    def starts_run(before_state, before_at, is_first):
        change = is_first | ~before_state.eqNullSafe(F.col("state"))
        if calendar:
            change = change | (F.date_diff(F.col(at), before_at) > 1)
        return F.when(change, 1).otherwise(0)

    spans = [F.min(at).alias("run_start"), F.max(at).alias("run_end"), F.count(F.lit(1)).alias("run_rows")]
    in_group = Window.partitionBy(*keys).orderBy(*order)
    so_far = in_group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.row_number().over(in_group) == 1
    plain = (
        ordinary.withColumn("_new", starts_run(F.lag("state").over(in_group), F.lag(at).over(in_group), first))
        .withColumn("_run", F.sum("_new").over(so_far))
        .groupBy(*keys, "_run", "state")
        .agg(*spans)
        .drop("_run")
    )
    if hot is None:
        return plain

    sliced, before, _ = _sliced_neighbours(hot, keys, order, ["state", at])
    other_group = before.isNull() | ~same_values([before[k] for k in keys], [F.col(k) for k in keys])
    within = Window.partitionBy(SLICE).orderBy(POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Runs inside a slice first: few rows are left to join across slices.
    parts = materialise(
        sliced.withColumn("_new", starts_run(before["state"], before[at], other_group))
        .withColumn("_local", F.sum("_new").over(within))
        .groupBy(SLICE, "_local", *keys, "state")
        .agg(F.sum("_new").alias("_new"), *spans),
        "runs",
    )
    offsets = _totals_before(parts, {"_before": F.sum("_new")})
    joined = (
        parts.join(offsets, SLICE)
        .withColumn("_run", F.col("_local") + F.col("_before"))
        .groupBy(*keys, "_run", "state")
        .agg(
            F.min("run_start").alias("run_start"),
            F.max("run_end").alias("run_end"),
            F.sum("run_rows").alias("run_rows"),
        )
        .drop("_run")
    )
    return plain.unionByName(joined)


def with_rank(
    df: DataFrame,
    keys: Sequence[str],
    score: str,
    name: str,
    dense: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add RANK (or DENSE_RANK) by descending score per group, over all rows if no keys are given.

    Meant for aggregated rows, which are stored once. Groups of a checked size are ranked
    by a window, larger ones through running counts over their distinct scores.
    """
    stored = materialise(df, "ranked")
    best_first = Window.partitionBy(*keys).orderBy(F.col(score).desc())
    rank = (F.dense_rank() if dense else F.rank()).over(best_first)
    if keys:
        ordinary, hot = split_hot(stored, keys, max_group_rows)
    else:
        ordinary, hot = (stored, None) if stored.count() <= max_group_rows else (None, stored)
    plain = None if ordinary is None else ordinary.withColumn(name, rank)
    if hot is None:
        return plain

    per_score = hot.groupBy(*keys, score).agg(F.count(F.lit(1)).alias("_n"))
    step = F.lit(1) if dense else F.col("_n")
    totals = running_totals(
        per_score.withColumn("_step", step.cast("long")), [*keys, F.col(score).desc()], {"_upto": "_step"}
    ).withColumn("_before", F.col("_upto") - F.col("_step"))
    start = F.lit(0)
    if keys:  # one row per large group
        starts = totals.groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys]).agg(F.min("_before").alias("_start"))
        on = same_values([F.col(k) for k in keys], [F.col(f"_g_{k}") for k in keys])
        totals, start = totals.join(F.broadcast(starts), on), F.col("_start")
    matched = [*keys, score]
    ranks = totals.select(
        *[F.col(c).alias(f"_r_{c}") for c in matched], (F.col("_before") - start + 1).cast("int").alias(name)
    )
    on = same_values([F.col(c) for c in matched], [F.col(f"_r_{c}") for c in matched])
    ranked = hot.join(ranks, on).select(*df.columns, name)
    return ranked if plain is None else plain.unionByName(ranked)


def _column(order: str | Column) -> Column:
    return F.col(order) if isinstance(order, str) else order
