"""The sliced road for large groups equals the plain window, whatever the skew."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import rows
from tidewheel.operators import ordered
from tidewheel.operators.analytics import decile_rate, lag_delta_buckets, league_table, longest_runs, rank_in_group
from tidewheel.operators.quantiles import fit_quantiles


@pytest.fixture(scope="module")
def series(spark):
    """900 rows: one key with a third of all rows, a null key, 40 small keys, tied values."""
    rng = random.Random(7)
    data = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else None if i % 3 == 1 and i % 5 == 0 else f"k{rng.randrange(40)}"
        value = 5.0 if rng.random() < 0.4 else round(rng.random() * 10, 1)
        data.append((key, i, value, rng.choice("ab"), rng.random() < 0.8))
    rng.shuffle(data)
    return spark.createDataFrame(data, "key string, at int, value double, kind string, ok boolean").repartition(5).cache()


LIMITS = [50, 10, 1]


@pytest.mark.parametrize("limit", LIMITS)
def test_neighbours(series, limit):
    window = Window.partitionBy("key").orderBy("at")
    expected = series.select(
        "*", F.lag("value").over(window).alias("before"), F.lead("kind").over(window).alias("after")
    )
    got = ordered.with_neighbours(series, ["key"], ["at"], {"before": "value"}, {"after": "kind"}, limit)
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("buckets", [10, 400])
def test_ntile(series, limit, buckets):
    window = Window.partitionBy("key").orderBy("value", "at")
    expected = series.withColumn("tile", F.ntile(buckets).over(window))
    got = ordered.with_ntile(series, ["key"], ["value", "at"], buckets, "tile", limit)
    assert rows(got) == rows(expected)


def _brute_runs(data, calendar):
    runs, last = [], {}
    for key, at, state in sorted(data, key=lambda r: (str(r[0]), r[1])):
        run = last.get(key)
        if run and run[1] == state and not (calendar and (at - run[3]).days > 1):
            run[3], run[4] = at, run[4] + 1
        else:
            run = last[key] = [key, state, at, at, 1]
            runs.append(run)
    return sorted((tuple(r) for r in runs), key=lambda t: tuple((v is None, str(v)) for v in t))


@pytest.mark.parametrize("limit", [10_000, *LIMITS])
@pytest.mark.parametrize("calendar", [False, True])
def test_runs(series, limit, calendar):
    days = series.withColumn("day", F.date_add(F.lit("2020-01-01").cast("date"), F.col("at")))
    got = ordered.run_spans(days, ["key"], ["day"], F.col("ok"), calendar, limit)
    data = [(r["key"], r["day"], r["ok"]) for r in days.collect()]
    assert rows(got, "key", "state", "run_start", "run_end", "run_rows") == _brute_runs(data, calendar)


def test_a_run_longer_than_many_slices(spark):
    data = spark.range(1000).select(F.lit("x").alias("key"), F.col("id").alias("at"), (F.col("id") != 700).alias("ok"))
    got = ordered.run_spans(data, ["key"], ["at"], F.col("ok"), max_group_rows=10)
    assert rows(got, "state", "run_start", "run_end", "run_rows") == [
        (False, 700, 700, 1),
        (True, 0, 699, 700),
        (True, 701, 999, 299),
    ]


def test_dense_id_counts_in_order(series):
    ids = ordered.dense_id(series, ["value", "at"], "id", slices=7)
    expected = series.withColumn("id", F.row_number().over(Window.orderBy("value", "at")).cast("long"))
    assert rows(ids) == rows(expected)


def test_dense_id_of_nothing(series):
    assert ordered.dense_id(series.where("false"), ["at"], "id").count() == 0


@pytest.mark.parametrize("limit", [10_000, 3])
def test_dim_id(series, limit):
    keys = series.select("kind", "ok").distinct()
    got = ordered.dim_id(keys, ["kind", "ok"], "id", limit)
    assert rows(got, "id", "kind", "ok") == [(1, "a", False), (2, "a", True), (3, "b", False), (4, "b", True)]


def test_running_totals(series):
    got = ordered.running_totals(
        series.select("at", "value"), [F.desc("at")], {"upto": "value"}, {"total": "at"}, {"next": "at"}, slices=6
    )
    window = Window.orderBy(F.desc("at"))
    expected = series.select(
        "at",
        "value",
        F.round(F.sum("value").over(window.rowsBetween(Window.unboundedPreceding, 0)), 6),
        F.sum("at").over(Window.partitionBy()),
        F.lead("at").over(window),
    )
    assert rows(got.withColumn("upto", F.round("upto", 6))) == rows(expected)


def _row_exchanges(df):
    """Shuffles of rows in the plan; single partitions and broadcasts hold one row per slice."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")


def test_sliced_rows_move_once(series):
    at = series.select("at", "key", "value")
    assert _row_exchanges(ordered.dense_id(at, ["at"], "id", slices=6)) == 0
    assert _row_exchanges(ordered.running_totals(at, ["at"], {"upto": "at"}, {"all": "at"}, {"next": "at"}, slices=6)) == 0
    sliced, before, after = ordered._sliced_neighbours(at, ["key"], ["at"], ["value"])
    assert _row_exchanges(sliced.select("at", before["value"], after["value"])) == 0


def test_running_totals_of_nothing_and_of_one_value(series):
    empty = ordered.running_totals(series.where("false"), ["at"], {"upto": "at"}, slices=3)
    assert empty.count() == 0
    same = series.select(F.lit(1).alias("one"), "at").withColumn("o", F.lit(0))
    got = ordered.running_totals(same, ["o", "at"], {"upto": "one"}, slices=900)  # more buckets than rows in most
    assert rows(got, "at", "upto") == rows(series.select("at", (F.col("at") + 1).alias("upto")))


@pytest.mark.parametrize("limit", [10_000, 5])
@pytest.mark.parametrize("dense", [False, True])
def test_rank_over_everything(series, limit, dense):
    scores = series.groupBy("key").agg(F.round(F.avg("value"), 0).alias("score"))
    rank = F.dense_rank() if dense else F.rank()
    expected = scores.withColumn("place", rank.over(Window.orderBy(F.desc("score"))))
    assert rows(ordered.with_rank(scores, [], "score", "place", dense, limit)) == rows(expected)


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("dense", [False, True])
def test_rank_in_groups(series, limit, dense):
    rank = F.dense_rank() if dense else F.rank()
    expected = series.withColumn("place", rank.over(Window.partitionBy("key").orderBy(F.desc("value"))))
    assert rows(ordered.with_rank(series, ["key"], "value", "place", dense, limit)) == rows(expected)


@pytest.mark.parametrize("interpolate", [False, True])
def test_quantiles_by_bracket_equal_quantiles_of_all_rows(series, interpolate):
    table = series.select("value", "at", F.when(F.col("at") > 5, F.col("value")).alias("gaps"), F.lit(None).cast("int").alias("none"))
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    small = fit_quantiles(table, table.columns, probabilities, interpolate)
    assert fit_quantiles(table, table.columns, probabilities, interpolate, max_group_rows=9) == small
    assert small["none"] == [None] * 6
    name = "percentile_cont" if interpolate else "percentile_disc"
    for column in ("value", "at", "gaps"):
        exprs = [F.expr(f"{name}({p}) WITHIN GROUP (ORDER BY CAST({column} AS DOUBLE))") for p in probabilities]
        assert small[column] == pytest.approx(list(table.agg(*exprs).first()))


def test_a_missed_bracket_is_looked_up_again(series, monkeypatch):
    expected = fit_quantiles(series, ["at", "value"], [0.1, 0.5, 0.9])
    monkeypatch.setattr("tidewheel.operators.quantiles._brackets", lambda sketch: [(2.0, 3.0), (9.9, 9.9)])
    assert fit_quantiles(series, ["at", "value"], [0.1, 0.5, 0.9], max_group_rows=9) == expected


def test_median_of_four(spark):
    four = spark.createDataFrame([(1,), (2,), (3,), (4,)], "x int")
    assert fit_quantiles(four, ["x"], [0.5]) == {"x": [2.0]}
    assert fit_quantiles(four, ["x"], [0.5], interpolate=True) == {"x": [2.5]}


def test_reports_do_not_depend_on_the_limit(series):
    def reports(limit):
        yield lag_delta_buckets(
            series, ["key"], ["at"], "value", F.col("next_kind") == "a", [(">", 2), (">=", 0)], ["big", "small", "rise"],
            outcome=("next_kind", "kind"), max_group_rows=limit,
        )
        yield decile_rate(series, ["key"], "value", ["at"], F.col("ok"), max_group_rows=limit)
        yield rank_in_group(series, "key", "kind", F.col("ok"), {}, max_group_rows=limit)
        yield longest_runs(series, ["key"], ["at"], F.col("ok"), 3, 15, max_group_rows=limit)
        yield league_table(
            series, "key", {"mean": (F.col("value"), 2)}, {"total": (F.col("at"), 0)}, F.col("ok"), max_group_rows=limit
        )

    for plain, sliced in zip(reports(10_000), reports(1)):
        assert rows(plain) == rows(sliced)
