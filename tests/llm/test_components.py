import random

from brute import smallest_reachable
from tidewheel.llm.components import components


def _found(spark, pairs):
    edges = spark.createDataFrame(pairs, "a long, b long")
    return {r["node"]: r["component"] for r in components(edges, "a", "b").collect()}


def test_random_graphs_paths_and_stars(spark):
    rng = random.Random(5)
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(501, 560)]
    loose = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)]
    pairs = [p for p in path + star + loose + loose[:5] if p[0] != p[1]]
    ids = {i for p in pairs for i in p if p[0] != p[1]}
    assert _found(spark, [*pairs, (7, 7)]) == smallest_reachable(ids, pairs)


def test_nulls_loops_and_nothing(spark):
    assert _found(spark, [(1, None), (None, None), (3, 3)]) == {}
    edges = spark.createDataFrame([("b", "a"), ("c", "b")], "x string, y string")
    assert {r["node"]: r["component"] for r in components(edges, "x", "y").collect()} == dict.fromkeys("abc", "a")
