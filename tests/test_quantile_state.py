"""Merged sketches answer within their error; ends and counts are exact."""

import pytest
from pyspark.sql import functions as F

from helpers import by
from tidewheel.operators.quantile_state import fit_from_state, merge_state, quantile_state, rank_error, state_quantiles
from tidewheel.plans.profiling import RANK_TOLERANCE


@pytest.fixture(scope="module")
def numbers(spark):
    """30,000 rows over 40 days; one day holds a third of them; x is a permutation of 0..29,999, gaps has nulls and NaN."""
    i = F.col("id")
    return spark.range(30_000, numPartitions=7).select(
        F.when(i % 3 == 0, 0).otherwise(i % 40).alias("day"),
        (i * 7919 % 30_000).alias("x"),
        F.when(i % 4 == 0, i.cast("double")).when(i % 4 == 1, float("nan")).alias("gaps"),
        F.lit(None).cast("double").alias("none"),
    )


def test_merged_states_keep_the_rank_error(spark, numbers, tmp_path):
    columns = ["x", "gaps", "none"]
    for part in (numbers.where("day < 20"), numbers.where("day >= 20")):  # as days come in
        quantile_state(part, ["day"], columns).write.mode("append").parquet(f"{tmp_path}/state")
    state = spark.read.parquet(f"{tmp_path}/state")
    assert state.count() == 40 and state.agg(F.sum("n_rows")).first()[0] == 30_000
    assert 3 * rank_error() < RANK_TOLERANCE
    probabilities = [0.0, 0.05, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = by(state_quantiles(merge_state(state, [], columns), [], columns, probabilities), "column")
    x = found["x"]["quantiles"]
    assert (found["x"]["n"], x[0], x[-1]) == (30_000, 0.0, 29_999.0)
    assert all(abs(v - p * 30_000) <= RANK_TOLERANCE * 30_000 for v, p in zip(x, probabilities))
    assert (found["gaps"]["n"], found["gaps"]["quantiles"][0], found["gaps"]["quantiles"][-1]) == (7_500, 0.0, 29_996.0)
    assert (found["none"]["n"], found["none"]["quantiles"]) == (0, None)
    fills = fit_from_state(state, columns)
    assert fills["none"] == [None] and fills["x"] == [pytest.approx(15_000, abs=RANK_TOLERANCE * 30_000)]


def test_no_rows_no_state(numbers):
    empty = quantile_state(numbers.where("false"), ["day"], ["x"])
    assert empty.count() == 0
    assert fit_from_state(empty, ["x"], [0.1, 0.9]) == {"x": [None, None]}


def test_a_sketch_does_not_grow_with_the_rows(numbers):
    size = lambda df: df.agg(F.max(F.length("x"))).first()[0]
    one = size(quantile_state(numbers, [], ["x"]))
    many = size(quantile_state(numbers.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20)))), [], ["x"]))
    assert many < 1.3 * one < 60_000
