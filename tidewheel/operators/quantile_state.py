"""Quantiles that are kept up to date: small sketches per day or file, stored, merged and asked later.

A state table has one row per group with the rows' count and, for each column, a KLL sketch of some kilobytes that does not
grow with the rows. New data adds rows to the stored table; old data is never read again. Use ``quantiles.fit_quantiles``
where values must be exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_K = 1000


def rank_error(k: int = DEFAULT_K) -> float:
    """The published error of a KLL sketch of size k: a share of all rows, kept to with a probability of 0.99, also after merging."""
    return 2.296 / k**0.9723


def quantile_state(df: DataFrame, keys: Sequence[str], columns: Sequence[str], k: int = DEFAULT_K) -> DataFrame:
    """One row per group of ``keys`` (the day, the file): ``n_rows`` and a sketch of each column's doubles.

    Nulls and NaN are left out. Sketches are partial aggregates: tasks sketch their own rows and only sketches are shuffled,
    so one group may hold any share of the rows.
    """
    sketches = [F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(c) for c in columns]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *sketches)


def merge_state(state: DataFrame, keys: Sequence[str], columns: Sequence[str], k: int = DEFAULT_K) -> DataFrame:
    """Fewer, larger groups from a state table; the order of merging does not matter for the error."""
    merged = [F.kll_merge_agg_double(c, k).alias(c) for c in columns]
    return state.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"), *merged)


def state_quantiles(
    state: DataFrame, keys: Sequence[str], columns: Sequence[str], probabilities: Sequence[float]
) -> DataFrame:
    """One row per group and column: ``keys``, ``column``, ``n`` values and an array ``quantiles``.

    Probabilities 0 and 1 give the exact least and greatest value. ``quantiles`` is null where the group has no value.
    """
    def asked(sketch: Column) -> Column:
        each = [F.kll_sketch_get_quantile_double(sketch, F.lit(float(p))) for p in probabilities]
        return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.array(*each))

    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.coalesce(F.kll_sketch_get_n_double(c), F.lit(0).cast("long")).alias("n"),
            asked(F.col(c)).alias("quantiles"),
        )
        for c in columns
    ]
    return state.select(*keys, F.inline(F.array(*cells)))


def fit_from_state(state: DataFrame, columns: Sequence[str], probabilities: Sequence[float] = (0.5,)) -> dict[str, list]:
    """Quantiles per column over all rows of a state table, in the form of ``fit_quantiles``: medians to impute with, say."""
    found = state_quantiles(merge_state(state, [], columns), [], columns, probabilities).collect()  # one row per column
    values = {r["column"]: r["quantiles"] for r in found}
    return {c: list(values[c]) if values[c] is not None else [None] * len(probabilities) for c in columns}
