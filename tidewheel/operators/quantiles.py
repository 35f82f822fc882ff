"""Exact quantiles of many columns, for tables of any size."""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import materialise
from .ordered import MAX_GROUP_ROWS, running_totals

_ACCURACY = 10_000
_LONG, _DOUBLE = T.LongType(), T.DoubleType()


def fit_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    interpolate: bool = False,
    accuracy: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> dict[str, list]:
    """Quantiles per column, nulls ignored; None for a column without values.

    ``interpolate=False`` returns an element of the column (2 for the median of
    1, 2, 3, 4), ``True`` interpolates (2.5). Integers and decimals keep their type, so large
    ones stay exact. One pass counts the values and sketches a bracket around each quantile; a
    second counts the values inside the brackets one by one and those outside together, and
    the counts are ordered; the built-in exact aggregates would hold all distinct values in one
    task. With ``accuracy`` the first pass alone answers: elements whose rank is off by at most
    rows / accuracy. The result is one number per column and probability. Runs jobs.
    """
    if not columns:
        return {}
    kinds = {c: _kind(df.schema[c].dataType) for c in columns}
    typed = df.select(*[F.col(c).cast(kinds[c]).alias(c) for c in columns])
    slack = 2.0 / _ACCURACY
    ends = [e for p in probabilities for e in (max(0.0, p - slack), min(1.0, p + slack))]
    asked = list(probabilities) if accuracy else ends
    first = typed.agg(
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.percentile_approx(c, asked, accuracy or _ACCURACY).alias(f"q{i}") for i, c in enumerate(columns)],
    ).first()
    sizes = {c: first[f"n{i}"] for i, c in enumerate(columns)}
    sketch = {c: first[f"q{i}"] for i, c in enumerate(columns) if sizes[c]}
    if accuracy:
        return {c: list(sketch[c]) if c in sketch else [None] * len(asked) for c in columns}

    ranks = {c: [_ranks(sizes[c], p, interpolate) for p in probabilities] for c in columns if sizes[c]}
    values = {}
    for kind in dict.fromkeys(kinds[c] for c in ranks):  # the cells of one pass have one type
        mine = {c: ranks[c] for c in ranks if kinds[c] == kind}
        bounds = _bounds(kind)
        found = _values_at_ranks(typed, {c: _brackets(sketch[c]) for c in mine}, mine, bounds, max_group_rows)
        missed = {c: ranks[c] for c, v in found.items() if None in v.values()}  # a bracket did not hold its rank
        if missed:
            found.update(_values_at_ranks(typed, {c: [bounds] for c in missed}, missed, bounds, max_group_rows))
        values.update(found)
    return {
        c: [_between(values[c][lo], values[c][hi], w) for lo, hi, w in ranks[c]] if c in ranks else [None] * len(probabilities)
        for c in columns
    }


def _kind(data_type: T.DataType) -> T.DataType:
    """The type in which a column's values are compared."""
    if isinstance(data_type, T.IntegralType):
        return _LONG
    return data_type if isinstance(data_type, T.DecimalType) else _DOUBLE


def _bounds(kind: T.DataType) -> tuple:
    """Values below and above all of a type."""
    if kind == _LONG:
        return -(2**63), 2**63 - 1
    if isinstance(kind, T.DecimalType):
        top = Decimal(10 ** kind.precision - 1).scaleb(-kind.scale)
        return -top, top
    return -math.inf, math.inf


def _between(low, high, weight: float):
    return low if weight == 0 or low == high else float(low) + (float(high) - float(low)) * weight


def _ranks(n: int, p: float, interpolate: bool) -> tuple[int, int, float]:
    """Lower rank, upper rank and the weight of the upper one."""
    if interpolate:
        at = p * (n - 1)
        return math.floor(at) + 1, math.ceil(at) + 1, at - math.floor(at)
    rank = max(1, math.ceil(p * n))
    return rank, rank, 0.0


def _brackets(sketch: Sequence) -> list[tuple]:
    """Disjoint ranges from the pairs of ends that a column's sketch gave."""
    merged: list[tuple] = []
    for low, high in sorted(zip(sketch[::2], sketch[1::2])):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def _values_at_ranks(df, brackets, ranks, bounds, max_group_rows):
    """Per column, the value at each rank; None where it lies outside the brackets."""
    columns = list(brackets)
    if not columns:
        return {}
    depth = max(map(len, brackets.values()))
    padded = [brackets[c] + [(bounds[1], bounds[1])] * (depth - len(brackets[c])) for c in columns]
    at = lambda per_column: F.array(*map(F.lit, per_column))[F.col("i")]
    # Zone 2j + 1 is bracket j, zone 2j the values between it and the bracket before.
    passed = [
        F.when(F.col("v") >= at([b[j][0] for b in padded]), 1).otherwise(0)
        + F.when(F.col("v") > at([b[j][1] for b in padded]), 1).otherwise(0)
        for j in range(depth)
    ]
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).alias("v")) for i, c in enumerate(columns)])
    rows = df.select(F.inline(cells)).where(F.col("v").isNotNull())
    rows = rows.withColumn("zone", reduce(lambda a, b: a + b, passed))
    inside = F.when(F.col("zone") % 2 == 1, F.col("v")).alias("value")
    counts = rows.groupBy("i", "zone", inside).agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(counts, "quantiles")
    if counts.count() <= max_group_rows:
        in_order = Window.partitionBy("i").orderBy("zone", "value").rowsBetween(Window.unboundedPreceding, 0)
        upto = counts.withColumn("upto", F.sum("n").over(in_order))
    else:
        total = running_totals(counts, ["i", "zone", "value"], {"all_upto": "n"})
        start = total.groupBy("i").agg(F.min(F.col("all_upto") - F.col("n")).alias("start"))  # a row per column
        upto = total.join(F.broadcast(start), "i").withColumn("upto", F.col("all_upto") - F.col("start"))
    wanted = [sorted({r for ends in ranks[c] for r in ends[:2]}) for c in columns]
    asked = df.sparkSession.createDataFrame(
        [(i, r) for i, w in enumerate(wanted) for r in w], "column int, rank long"
    )  # one row per wanted rank
    hit = (F.col("i") == F.col("column")) & (F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n"))
    found = upto.join(F.broadcast(asked), hit).select("i", "value", "rank").collect()
    values = {c: dict.fromkeys(w) for c, w in zip(columns, wanted)}
    for row in found:
        values[columns[row["i"]]][row["rank"]] = row["value"]
    return values
