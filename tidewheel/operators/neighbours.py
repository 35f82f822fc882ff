"""Mutual information by nearest neighbours, for columns of any length.

The estimator looks, for every value, for the distance to the k-th nearest value of the same class, and counts the values
of all classes that are nearer. Both need sorted values, and neither needs them in one task: values are counted first,
range-partitioned into *slices* and walked through by the task that has sorted them. Of a slice's neighbours a task
lacks only some rows at either end; those rows are finished together afterwards, 4 k of them for each slice.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import materialise

_EULER = 0.5772156649015329
_SMALL = 16  # below this digamma is read from a list, from it on a short series is exact to 1e-13
_TOP_BITS = np.int64(0x7FFFFFFFFFFFFFFF)


def digamma(n: Column) -> Column:
    """The digamma function of a positive whole number."""
    harmonic = np.concatenate([[0.0], np.cumsum(1.0 / np.arange(1, _SMALL))])
    listed = F.array(*[F.lit(float(h - _EULER)) for h in harmonic])
    x = n.cast("double")
    series = F.log(x) - 1 / (2 * x) - 1 / (12 * x * x) + 1 / (120 * x * x * x * x) - 1 / (252 * x * x * x * x * x * x)
    return F.when(n < _SMALL, F.get(listed, n.cast("int") - 1)).otherwise(series)


def mutual_info_neighbours(
    df: DataFrame, features: Sequence[str], label: Column, k: int = 3, slices: int | None = None
) -> DataFrame:
    """``feature, mi, n``: mutual information (nats) of each numeric feature with a discrete label, and the values used.

    With psi as digamma, ``mi = psi(n) + mean(psi(k_y) - psi(n_y) - psi(m))`` over the values of a feature, at least 0: n_y
    values have the same label, k_y is the smaller of ``k`` and n_y - 1, and m counts the values of all labels that are
    nearer than the k_y-th nearest of the same label, or equal if that one is equal. Nulls, values that are not finite and labels with
    one value do not count for the feature; a feature without values is left out. Distances are differences of
    doubles, compared exactly, so equal steps on a decimal grid may differ in the last bit.

    Values are counted per feature and label before anything is shuffled. Runs jobs.
    """
    names = list(features)
    cells = F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("v")) for i, c in enumerate(names)])
    finite = F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < float("inf"))
    counted = (
        df.select(label.cast("string").alias("y"), cells.alias("cells"))
        .where(F.col("y").isNotNull())
        .select("y", F.inline("cells"))
        .where(finite)
        .groupBy("f", "y", (F.col("v") + 0.0).alias("v"))  # one zero
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counted = materialise(counted, "counted")
    classes = counted.groupBy("f", "y").agg(F.sum("n").alias("n_y")).where("n_y > 1")
    classes = materialise(classes.withColumn("k_y", F.least(F.lit(k).cast("long"), F.col("n_y") - 1)), "classes")
    used = counted.join(classes, ["f", "y"])  # Spark goes by the stored size
    measured = _with_radius(used, k, slices)
    within = _within(measured, slices)
    n = F.sum("n")
    terms = digamma(F.col("k_y")) - digamma(F.col("n_y")) - digamma(F.col("m"))
    found = within.groupBy("f").agg(n.alias("n"), (F.sum(F.col("n") * terms) / n).alias("mean"))
    feature = F.array(*map(F.lit, names))[F.col("f")].alias("feature")
    return found.select(feature, F.greatest(F.lit(0.0), digamma(F.col("n")) + F.col("mean")).alias("mi"), "n")


def _in_order(df: DataFrame, order: Sequence[str], slices: int | None) -> DataFrame:
    target = [slices, *order] if slices else list(order)
    return df.repartitionByRange(*target).sortWithinPartitions(*order)


_VALUE = "f int, y string, v double, n long, n_y long, k_y long"


def _with_radius(used: DataFrame, k: int, slices: int | None) -> DataFrame:
    """Adds ``lo`` and ``hi``: the first and last number that is nearer than the k-th neighbour of the same class."""
    order = ["f", "y", "v"]
    shape = f"{_VALUE}, lo double, hi double, edge boolean"
    walked = _in_order(used.select(*order, "n", "n_y", "k_y"), order, slices).mapInArrow(partial(_walk, k, True), shape)
    walked = materialise(walked, "radius")
    # 4 k rows of a slice at most, and no more slices than shuffle partitions: one task sorts them.
    edges = walked.where("edge").repartition(1).sortWithinPartitions(*order)
    finished = edges.mapInArrow(partial(_walk, k, False), shape)
    return walked.where("lo IS NOT NULL").unionByName(finished).drop("edge")


def _walk(k: int, sliced: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Radius of each row from the k rows before and after it.

    In a slice, rows less than k from either end stay open (``lo`` and ``hi`` null), and those less than 2 k from it are marked as
    ``edge``. Otherwise the rows are the edges of all slices, and those that are open get their radius.
    """
    schema = pa.schema([("f", pa.int32()), ("y", pa.string()), *((c, pa.float64()) for c in "v")])
    schema = pa.schema([*schema, *((c, pa.int64()) for c in ("n", "n_y", "k_y"))])
    schema = pa.schema([*schema, ("lo", pa.float64()), ("hi", pa.float64()), ("edge", pa.bool_())])
    held: pa.Table | None = None  # up to 3 k rows of which the first ``done`` are finished
    done = seen = 0

    def finish(table: pa.Table, first: int, last: int, at: int) -> pa.Table:
        """Rows ``first:last`` of a table whose row 0 is the ``at``-th of the slice."""
        lo, hi = _interval(table, k)
        place = np.arange(table.num_rows) + at
        edge = place < 2 * k
        open_rows = place < k
        out = table.select(["f", "y", "v", "n", "n_y", "k_y"])
        if sliced:
            lo[open_rows], hi[open_rows] = np.nan, np.nan
        out = out.append_column("lo", pa.array(lo, from_pandas=True))
        out = out.append_column("hi", pa.array(hi, from_pandas=True)).append_column("edge", pa.array(edge))
        return out.slice(first, last - first)

    def emitted(table: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from table.cast(schema).to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        new = pa.Table.from_batches([batch])
        table = new if held is None else pa.concat_tables([held, new])
        at = seen - (held.num_rows if held is not None else 0)
        seen += new.num_rows
        last = max(done, table.num_rows - 2 * k)  # later rows may be an edge
        if last > done:
            part = finish(table, done, last, at)
            yield from emitted(part if sliced else _reopened(part, table.slice(done, last - done)))
        keep = max(0, last - k)
        held, done = table.slice(keep), last - keep
    if held is not None:
        at = seen - held.num_rows
        part = finish(held, done, held.num_rows, at)
        if sliced:
            place = np.arange(done, held.num_rows)
            closed = place < held.num_rows - k
            for name in ("lo", "hi"):
                column = pa.array(np.where(closed, part.column(name).to_numpy(zero_copy_only=False), np.nan), from_pandas=True)
                part = part.set_column(part.schema.get_field_index(name), name, column)
            edge = pa.array(np.ones(len(place), dtype=bool))
            part = part.set_column(part.schema.get_field_index("edge"), "edge", edge)
            yield from emitted(part)
        else:
            yield from emitted(_reopened(part, held.slice(done)))


def _reopened(found: pa.Table, given: pa.Table) -> pa.Table:
    """Of the edge rows those that no slice could finish."""
    return found.filter(given.column("lo").is_null())


def _interval(table: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last number nearer to each value than its k_y-th neighbour of the same feature and class."""
    v, n = table.column("v").to_numpy(), table.column("n").to_numpy()
    f = table.column("f").to_numpy()
    y = table.column("y").combine_chunks().dictionary_encode().indices.to_numpy()
    wanted = table.column("k_y").to_numpy()
    size = len(v)
    distance = np.full((size, 2 * k + 1), np.inf)
    count = np.zeros((size, 2 * k + 1), dtype=np.int64)
    distance[:, 0], count[:, 0] = 0.0, n - 1
    for step in range(1, k + 1):
        if step >= size:
            break
        same = (f[step:] == f[:-step]) & (y[step:] == y[:-step])
        apart = np.where(same, v[step:] - v[:-step], np.inf)
        distance[step:, 2 * step - 1] = apart
        count[step:, 2 * step - 1] = np.where(same, n[:-step], 0)
        distance[:-step, 2 * step] = apart
        count[:-step, 2 * step] = np.where(same, n[step:], 0)
    nearest = np.argsort(distance, axis=1, kind="stable")
    met = np.cumsum(np.take_along_axis(count, nearest, axis=1), axis=1) >= wanted[:, None]
    radius = np.take_along_axis(distance, nearest, axis=1)[np.arange(size), met.argmax(axis=1)]
    return _first_within(v, radius), -_first_within(-v, radius)


def _first_within(v: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """The smallest double x with ``v - x < radius`` as doubles are subtracted; v itself if the radius is 0.

    The difference never falls when x does, so x is found by halving the doubles between.
    """
    low = _ordered(np.maximum(v - 2 * radius, -np.finfo(float).max))
    low = np.where(v - _double(low) < radius, _ordered(np.full(len(v), -np.finfo(float).max)), low)
    high = _ordered(v)
    for _ in range(64):
        middle = (low & high) + ((low ^ high) >> 1)
        inside = v - _double(middle) < radius
        high = np.where(inside, middle, high)
        low = np.where(inside, low, middle)
    return np.where(radius > 0, _double(high), v)


def _ordered(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles."""
    bits = np.ascontiguousarray(x, dtype=np.float64).view(np.int64)
    return np.where(bits < 0, -(bits & _TOP_BITS), bits)


def _double(n: np.ndarray) -> np.ndarray:
    bits = np.where(n < 0, (-n) | ~_TOP_BITS, n)
    return np.ascontiguousarray(bits).view(np.float64)


def _within(measured: DataFrame, slices: int | None) -> DataFrame:
    """Adds ``m``, the values of all classes of the feature between ``lo`` and ``hi``, by one merge of values and bounds.

    A bound's running count is that of its slice plus those of all slices before; one row per slice is joined.
    """
    measured = materialise(measured, "measured")
    point = F.struct(F.col("v").alias("x"), F.lit(1).alias("kind"), F.lit(0).alias("sign"))
    lower = F.struct(F.col("lo").alias("x"), F.lit(0).alias("kind"), F.lit(-1).alias("sign"))
    upper = F.struct(F.col("hi").alias("x"), F.lit(2).alias("kind"), F.lit(1).alias("sign"))
    columns = ["y", "v", "n", "n_y", "k_y"]
    events = measured.select("f", *columns, F.inline(F.array(point, lower, upper)))
    order = ["f", "x", "kind"]
    shape = "f int, y string, v double, n long, n_y long, k_y long, sign int, slice int, upto long"
    summed = materialise(_in_order(events, order, slices).mapInArrow(_running, shape), "running")
    totals = summed.groupBy("slice").agg(F.sum(F.when(F.col("sign") == 0, F.col("n")).otherwise(0)).alias("_total"))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    before = totals.select("slice", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    bounds = summed.where("sign != 0").join(F.broadcast(before), "slice")
    m = F.sum(F.col("sign") * (F.col("upto") + F.col("_before")))
    return bounds.groupBy("f", "y", "v").agg(*[F.first(c).alias(c) for c in columns[2:]], m.alias("m"))


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running count of the points of a slice, in the task that has sorted them."""
    from pyspark import TaskContext

    piece, total = TaskContext.get().partitionId(), 0
    names = ["f", "y", "v", "n", "n_y", "k_y", "sign"]
    for batch in batches:
        points = np.where(batch.column("sign").to_numpy() == 0, batch.column("n").to_numpy(), 0)
        upto = np.cumsum(points) + total
        total = int(upto[-1]) if len(upto) else total
        columns = [*(batch.column(c) for c in names), pa.array(np.full(batch.num_rows, piece, np.int32)), pa.array(upto, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, [*names, "slice", "upto"])
