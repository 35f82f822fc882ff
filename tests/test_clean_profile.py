import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import by, rows
from tidewheel.operators import clean, profile
from tidewheel.operators.analytics import lag_delta_buckets, longest_runs, period_vs_mean


@pytest.fixture(scope="module")
def gaps(spark):
    data = [(1, "a", 1.0, None), (2, "b", None, None), (None, "b", 3.0, None), (4, None, 4.0, None), (9, "a", 9.5, "x")]
    return spark.createDataFrame(data, "n int, c string, v double, mostly string").withColumn(
        "never", F.lit(None).cast("double")
    )


def test_missing_profile_and_severity(gaps):
    got = by(profile.missing_severity(gaps), "column")
    assert (got["n"]["missing"], got["n"]["missing_pct"], got["n"]["severity"]) == (1, 20.0, "Moderate Missing")
    assert (got["mostly"]["missing_pct"], got["mostly"]["severity"]) == (80.0, "Critical Missing")
    assert got["never"]["missing_pct"] == 100.0
    order = [r["column"] for r in profile.missing_severity(gaps).collect()]
    assert order == ["never", "mostly", "c", "n", "v"]


@pytest.mark.parametrize("nulls, severity", [(0, "No"), (1, "Low"), (5, "Moderate"), (30, "High"), (50, "Critical")])
def test_severity_bounds(spark, nulls, severity):
    df = spark.range(100).select(F.when(F.col("id") >= nulls, 1).alias("x"))
    assert profile.missing_severity(df).first()["severity"] == f"{severity} Missing"


def test_drop_sparse_columns(gaps):
    assert clean.drop_sparse_columns(gaps, 30.0).columns == ["n", "c", "v"]
    assert clean.drop_sparse_columns(gaps, columns=["c", "absent"]).columns == ["n", "v", "mostly", "never"]


def test_modes_take_the_smallest_of_a_tie_and_skip_nulls(gaps):
    modes = {r["column"]: r["mode"] for r in clean.modes_of(gaps, ["c", "mostly"]).collect()}
    assert modes == {"c": "a", "mostly": "x"}


def test_imputation_leaves_an_empty_column_alone_and_truncates_into_int(spark, gaps):
    filled = clean.impute(gaps, numeric=["n", "v", "never"], categorical=["c", "mostly"])
    got = filled.orderBy("v").collect()
    assert [r["n"] for r in got] == [1, 2, 2, 4, 9]
    assert sorted(r["v"] for r in got) == [1.0, 3.0, 3.0, 4.0, 9.5]
    assert {r["never"] for r in got} == {None}
    two_seven = clean.FillValues({"n": 2.7}).apply(gaps)
    assert two_seven.where("c = 'b' and v = 3.0").first()["n"] == 2


def test_fill_values_survive_saving(spark, gaps, tmp_path):
    fills = clean.fit_fill_values(gaps, ["n", "v"], ["c"])
    fills.save(spark, f"{tmp_path}/fills")
    assert clean.FillValues.load(spark, f"{tmp_path}/fills") == fills


def test_dup_profile_counts_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x"), (2, "x"), (2, "x"), (2, "x")], "a int, b string")
    assert tuple(profile.dup_profile(df).first()) == (6, 2, 3, 3)
    assert tuple(profile.dup_profile(df.where("false")).first()) == (0, 2, 0, 0)


def test_duplicates_stay_exact_when_hashes_collide(spark):
    data = [(i % 40, None if i % 3 else "x", float(i % 2) * -0.0) for i in range(400)] + [(None, "1", 0.0), (1, None, 0.0)]
    df = spark.createDataFrame(data, "a int, b string, c double")
    exact = (402, 3, df.distinct().count(), 402 - df.distinct().count())
    for bits in (64, 4, 1):
        assert tuple(profile.dup_profile(df, bits).first()) == exact
    nested = df.selectExpr("array(a, 1) AS a", "struct(b, c) AS b")
    assert profile.dup_profile(nested).first()["distinct_rows"] == nested.distinct().count()


def test_cardinality_is_counted_by_type_not_as_text(spark):
    rows_ = [(1, 1.5, -0.0, True, b"a", "1", dt.date(2020, 1, 1), [1]), (1, 1.5, 0.0, None, b"a", None, dt.date(2020, 1, 2), [2])] * 3
    df = spark.createDataFrame(rows_, "i int, f float, d double, t boolean, b binary, s string, day date, l array<int>")
    df = df.withColumns({"money": F.col("i").cast("decimal(10,2)"), "at": F.col("day").cast("timestamp"), "local": F.col("day").cast("timestamp_ntz")})
    found = profile.cardinality_profile(df)
    assert {r["column"]: r["distinct_values"] for r in found.collect()} == {
        "i": 1, "f": 1, "d": 1, "t": 2, "b": 1, "s": 2, "day": 2, "l": 2, "money": 1, "at": 2, "local": 2
    }
    assert "as string" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_cardinality_counts_null_as_a_value(gaps):
    exact = by(profile.cardinality_profile(gaps), "column")
    rough = by(profile.cardinality_profile(gaps, approximate=True), "column")
    for column, n in {"n": 5, "c": 3, "v": 5, "mostly": 2, "never": 1}.items():
        assert exact[column]["distinct_values"] == n
        assert rough[column]["distinct_values"] == n


def test_frequency_table(gaps):
    got = rows(profile.frequency_table(gaps, ["c"], top=2), "column", "value", "n", "position")
    assert got == [("c", "a", 2, 1), ("c", "b", 2, 2)]


def test_frequency_table_limits_before_the_ranking_shuffle(gaps):
    plan = profile.frequency_table(gaps, ["c"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4


def test_describe_has_types_and_text_extremes(gaps):
    got = by(profile.describe_profile(gaps), "column")
    assert got["n"]["data_type"] == "int" and got["n"]["non_null"] == 4 and got["n"]["mean"] == 4.0
    assert (got["c"]["min_text"], got["c"]["max_text"], got["c"]["mean"]) == ("a", "b", None)
    assert got["never"]["non_null"] == 0 and got["never"]["min_value"] is None


def test_box_stats(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 5, 6, 7, 8, 100]], "x double")
    row = profile.box_stats(df).first()
    assert tuple(row) == ("x", 3.0, 5.0, 7.0, 1.0, 8.0, 1)


def test_corr_matrix_skips_null_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (4.0, 8.0)], "a double, b double")
    row = profile.corr_matrix(df).first()
    assert (row["x"], row["y"]) == ("b", "a") and row["r"] == pytest.approx(1.0)


def test_mutual_info_and_selection(spark):
    df = spark.range(1000).select(
        F.col("id").cast("double").alias("a"),
        (F.col("id") * 2 + F.col("id") % 7).cast("double").alias("b"),
        (F.col("id") * 37 % 101).cast("double").alias("noise"),
        (F.col("id") >= 500).cast("int").alias("label"),
    )
    mi = by(profile.mutual_info(df, ["a", "b", "noise"], F.col("label")), "feature")
    assert mi["a"]["mi"] == pytest.approx(0.6931, abs=1e-3)  # ln 2: a decides the label
    assert mi["noise"]["mi"] < 0.05
    kept = {r["feature"]: r["kept"] for r in profile.select_features(df, ["a", "b", "noise"], F.col("label")).collect()}
    assert kept["noise"] and sorted([kept["a"], kept["b"]]) == [False, True]


def test_runs_end_where_another_state_comes_between(spark):
    day = lambda d: dt.date(2020, 1, d)
    df = spark.createDataFrame([("x", day(1), "No"), ("x", day(2), "Yes"), ("x", day(3), "No"), ("x", day(4), "No")], "k string, d date, rain string")
    got = longest_runs(df, ["k"], ["d"], F.col("rain") == "No")
    assert rows(got, "run_start", "run_end", "run_rows", "length_rank") == [
        (day(1), day(1), 1, 2),
        (day(3), day(4), 2, 1),
    ]


def test_calendar_runs_end_at_a_missing_day(spark):
    day = lambda d: dt.date(2020, 1, d)
    df = spark.createDataFrame([("x", day(d)) for d in (1, 2, 5)], "k string, d date")
    assert longest_runs(df, ["k"], ["d"], F.lit(True)).first()["run_rows"] == 3
    assert longest_runs(df, ["k"], ["d"], F.lit(True), calendar=True).first()["run_rows"] == 2


def test_lag_of_the_previous_row_or_of_the_previous_day_only(spark):
    data = [("x", dt.date(2020, 1, 1), 10.0), ("x", dt.date(2020, 1, 2), 4.0), ("x", dt.date(2020, 1, 5), 1.0)]
    df = spark.createDataFrame(data, "k string, d date, v double")
    args = (df, ["k"], ["d"], "v", F.lit(True), [(">", 5), (">", 2)], ["sharp", "fall", "else"])
    assert rows(lag_delta_buckets(*args), "change_band", "n") == [("fall", 1), ("sharp", 1)]
    assert rows(lag_delta_buckets(*args, max_gap_days=1), "change_band", "n") == [("sharp", 1)]


def test_period_verdicts(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 10.0), (3, 40.0)], "p int, v double")
    got = period_vs_mean(df, {"p": F.col("p")}, F.col("v") > 10, F.col("v"), labels=("wet", "dry", "normal"))
    assert rows(got, "p", "hit_pct", "overall_mean", "deviation", "verdict") == [
        (1, 0.0, 20.0, -10.0, "dry"),
        (2, 0.0, 20.0, -10.0, "dry"),
        (3, 100.0, 20.0, 20.0, "wet"),
    ]
