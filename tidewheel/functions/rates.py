"""Counts, percentages and bands. Percentages are computed in double."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def match_count(condition: Column) -> Column:
    """Number of rows meeting the condition (null counts as not met)."""
    return F.count_if(condition)


def percent_where(condition: Column, digits: int | None = 1) -> Column:
    """Percentage of rows meeting the condition; ``digits=None`` leaves it unrounded."""
    share = F.lit(100.0) * F.count_if(condition) / F.count(F.lit(1))
    return share if digits is None else F.round(share, digits)


def conditional_percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percentage of ``whole`` rows that also meet ``part``; null if there are none."""
    hits = F.count_if(whole & part)
    return F.round(F.lit(100.0) * hits / F.nullif(F.count_if(whole), F.lit(0)), digits)


def band(value: Column, limits: Sequence[tuple[str, float]], labels: Sequence[str]) -> Column:
    """Label of the first limit that holds, else the last label.

    ``limits`` are (operator, bound) pairs, for example ``(">", 5), (">", 2), (">=", 0)``
    with four labels. Null falls to the last label, as in a searched CASE with ELSE.
    """
    tests = {
        ">": lambda b: value > b,
        ">=": lambda b: value >= b,
        "<": lambda b: value < b,
        "<=": lambda b: value <= b,
    }
    if len(labels) != len(limits) + 1:
        raise ValueError("one label more than limits is needed")
    choice = None
    for (op, bound), label in zip(limits, labels):
        test = tests[op](F.lit(bound))
        choice = F.when(test, F.lit(label)) if choice is None else choice.when(test, F.lit(label))
    return F.lit(labels[0]) if choice is None else choice.otherwise(F.lit(labels[-1]))


def tag(value: Column, names: Mapping) -> Column:
    """Name of a value from a lookup; null when it has none."""
    return F.coalesce(*[F.when(value == F.lit(k), F.lit(v)) for k, v in names.items()])
