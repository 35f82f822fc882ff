"""Nearest-neighbour mutual information against distances of all pairs."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewheel.operators import neighbours


def psi(n):
    return sum(1 / i for i in range(1, n)) - 0.5772156649015329


def plain(values, k):
    """(mi, n) of ``(value, label)`` pairs by comparing all of them."""
    values = [(v, y) for v, y in values if v is not None and y is not None and math.isfinite(v)]
    sizes = Counter(y for _, y in values)
    values = [(v, y) for v, y in values if sizes[y] > 1]
    if not values:
        return None
    total = 0.0
    for i, (v, y) in enumerate(values):
        near = min(k, sizes[y] - 1)
        radius = sorted(abs(v - w) for j, (w, z) in enumerate(values) if z == y and j != i)[near - 1]
        m = sum(abs(v - w) < radius if radius > 0 else w == v for w, _ in values)
        total += psi(near) - psi(sizes[y]) - psi(m)
    return max(0.0, psi(len(values)) + total / len(values)), len(values)


def table(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        y = rng.choice(["a", "a", "b", "c", None])
        shift = {"a": 0.0, "b": 1.5}.get(y, 0.4)
        rows.append(
            (
                y,
                rng.gauss(shift, 1),
                round(rng.gauss(shift, 1), 1),  # a grid: equal values, equal steps
                rng.choice([0.0, -0.0, 1e300, -1e300, 1e-300, float("nan"), float("inf"), 3.0, 0.1 + 0.2, 0.3]),
                rng.randrange(3) if rng.random() < 0.9 else None,
                None,
            )
        )
    return [*rows, ("alone", 0.5, 0.5, 0.5, 1, None)]


NAMES = ["normal", "grid", "odd", "few", "nothing"]


@pytest.mark.parametrize("k,slices", [(3, None), (3, 37), (1, 150), (5, 400), (30, 8)])
def test_matches_all_pairs_whatever_the_slices(spark, k, slices):
    data = table(k)
    df = spark.createDataFrame(data, "label string, normal double, grid double, odd double, few int, nothing double").repartition(3)
    got = {r["feature"]: (r["mi"], r["n"]) for r in neighbours.mutual_info_neighbours(df, NAMES, F.col("label"), k, slices).collect()}
    want = {name: plain([(r[i + 1], r[0]) for r in data], k) for i, name in enumerate(NAMES)}
    assert set(got) == {"normal", "grid", "odd", "few"}
    for name, (mi, n) in got.items():
        assert n == want[name][1] and mi == pytest.approx(want[name][0], abs=1e-9), name


def test_batches_of_one_task_are_joined(spark):
    """Many small batches in one slice give the result of one."""
    data = [(r[0], r[1]) for r in table(9)]
    df = spark.createDataFrame(data, "label string, normal double")
    one = neighbours.mutual_info_neighbours(df, ["normal"], F.col("label"), 3, 1).first()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        many = neighbours.mutual_info_neighbours(df, ["normal"], F.col("label"), 3, 2).first()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert one["mi"] == pytest.approx(many["mi"], abs=1e-12) and one["n"] == many["n"]


def test_empty_and_constant_columns(spark):
    empty = spark.createDataFrame([], "label string, x double")
    assert neighbours.mutual_info_neighbours(empty, ["x"], F.col("label")).collect() == []
    same = spark.createDataFrame([("a", 1.0)] * 5 + [("b", 1.0)] * 5, "label string, x double")
    row = neighbours.mutual_info_neighbours(same, ["x"], F.col("label")).first()
    assert row["mi"] == pytest.approx(max(0.0, plain([(1.0, "a")] * 5 + [(1.0, "b")] * 5, 3)[0]))


def test_bounds_are_the_last_doubles_inside():
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.normal(size=200), np.round(rng.normal(size=200), 2), [1000.0, 0.0, -5e-324]])
    radius = np.abs(np.concatenate([rng.normal(size=200), np.round(rng.normal(size=200), 2), [999.99, 0.0, 1e-300]]))
    lo = neighbours._first_within(v, radius)
    some = radius > 0
    assert (v[some] - lo[some] < radius[some]).all()
    assert not (v[some] - np.nextafter(lo[some], -np.inf) < radius[some]).any()
    assert (lo[~some] == v[~some]).all()


def test_digamma(spark):
    values = [1, 2, 15, 16, 17, 1000, 10**12]
    rows = spark.createDataFrame([(n,) for n in values], "n long").select("n", neighbours.digamma(F.col("n")).alias("p")).collect()
    for n, p in rows:
        want = psi(n) if n <= 1000 else math.log(n) - 1 / (2 * n)
        assert p == pytest.approx(want, abs=1e-12)
