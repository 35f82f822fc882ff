"""Rows that clean test tables lack: each case once gave a wrong result, a lost row or an error."""

import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from helpers import by, rows
from tidewheel.operators import analytics, features, profile, split
from tidewheel.operators.evaluate import weighted_f1
from tidewheel.operators.quantiles import fit_quantiles
from tidewheel.sources import read_csv, write_csv
from tidewheel.sources.jdbc import latest_batch
from tidewheel.streaming.cdc import cdc_unwrap


def test_running_sum_keeps_amounts_below_a_cent(spark):
    df = spark.range(250).selectExpr("'k' AS k", "DATE'2020-01-02' AS d", "0.004D AS amount")
    total = analytics.ytd_running_sum(df, ["k"], "d", "amount", {2020: "x"}, digits=3).first()
    assert total["day_amount"] == total["ytd_amount"] == 1.0


def test_bare_row_may_own_a_column_op(spark):
    schema = StructType([StructField("id", IntegerType())])
    texts = [
        '{"id":1,"op":"d"}',
        '{"payload":{"id":2,"op":"d"}}',
        '{"op":"d","before":{"id":3},"after":null}',
        '{"payload":{"before":{"id":4},"after":null,"op":"d"}}',
        '{"payload":{"before":null,"after":null,"op":"d"}}',
        '{"payload":{"after":{"id":5},"op":"u"}}',
        '{"after":{"id":6}}',
        "[1]",
        None,
    ]
    out = cdc_unwrap(spark.createDataFrame([(t,) for t in texts], "value string"), schema)
    assert [(r["change"], r["id"]) for r in out.collect()] == [
        ("upsert", 1),
        ("upsert", 2),
        ("delete", 3),
        ("delete", 4),
        ("delete", None),
        ("upsert", 5),
        ("upsert", 6),
        ("invalid", None),
        ("invalid", None),
    ]


def test_csv_keeps_or_refuses_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb"), (2, 'c"\r\n,d'), (3, None)], "id int, t string")
    write_csv(df, f"{tmp_path}/kept", multi_line=True)
    assert rows(read_csv(spark, f"{tmp_path}/kept", df.schema, multi_line=True)) == rows(df)
    with pytest.raises(PySparkException, match="line break"):
        write_csv(df, f"{tmp_path}/refused")


def test_unlabelled_rows_do_not_count_for_f1(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 0.0), (None, 1.0)], "y double, p double")
    assert weighted_f1(df, F.col("y"), F.col("p")).first().asDict() == {"weighted_f1": 1.0, "n": 2}


def test_zeros_are_one_value_and_repeated_hours_are_two(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (math.nan,), (None,)], "x double")
    assert profile.cardinality_profile(df).first()["distinct_values"] == df.distinct().count() == 3
    zone = spark.conf.get("spark.sql.session.timeZone")
    times = spark.createDataFrame([(1698539400,), (1698543000,)], "s long").select(F.timestamp_seconds("s").alias("t"))
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        assert profile.cardinality_profile(times).first()["distinct_values"] == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_profile_lists_every_column(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2020, 1, 2), True, [1]), (2, None, False, None)], "n int, d date, b boolean, a array<int>"
    )
    found = by(profile.describe_profile(df), "column")
    assert set(found) == {"n", "d", "b", "a"}
    assert (found["d"]["non_null"], found["d"]["min_text"], found["b"]["max_text"]) == (1, "2020-01-02", "true")
    assert profile.describe_profile(df.select("n")).count() == 1
    assert profile.describe_profile(df.select("d")).count() == 1


def test_box_stats_of_columns_without_values(spark):
    df = spark.createDataFrame([(None, None)], "x double, y int")
    assert profile.box_stats(df).count() == 0
    assert "outliers" in profile.box_stats(df).columns


def test_both_splits_agree(spark):
    df = spark.range(2000)
    train, _ = split.hash_split(df, ["id"], 0.65)
    tagged = split.with_split(df, ["id"], 0.65).where("part = 'train'").drop("part")
    assert rows(train) == rows(tagged)


def test_versions_in_one_batch_are_ordered(spark):
    df = spark.createDataFrame([(1, 5.0, 3, 1), (1, 7.0, 3, 2), (1, 6.0, 2, 9)], "id int, p double, batch_id long, at long")
    assert rows(latest_batch(df, "id", ["at"]), "id", "p") == [(1, 7.0)]


def test_reports_without_groups(spark):
    df = spark.range(10).withColumn("even", F.col("id") % 2 == 0)
    assert analytics.conditional_rate(df, [], F.col("even")).first()["hit_pct"] == 50.0
    assert analytics.persistence_rate(df, [], F.col("even"), F.col("even")).first()["persistence_pct"] == 100.0


def test_one_row_totals_are_no_window(spark):
    df = spark.range(10).withColumn("c", F.col("id") % 3)
    assert by(profile.class_balance(df, "c"), "c")[0]["share_pct"] == 40.0
    plan = profile.class_balance(df, "c")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_quantiles_keep_large_integers_and_decimals(spark):
    big = [2**60 + 1, 2**60 + 3, 2**60 + 5]
    df = spark.createDataFrame([(v, Decimal(f"{i}.{10**17 + i}")) for i, v in enumerate(big)], "b long, d decimal(38,18)")
    found = fit_quantiles(df, ["b", "d"], [0.5])
    assert found == {"b": [big[1]], "d": [Decimal("1.100000000000000001")]}
    ends = fit_quantiles(spark.range(1, 1001), ["id"], [0.0, 0.5, 1.0], accuracy=100)["id"]
    assert abs(ends[1] - 500) <= 10 and ends[0] == 1 and ends[2] == 1000


def test_frequencies_beyond_a_thousand_values(spark):
    df = spark.range(6000).selectExpr("CAST(id % 3000 AS STRING) AS v")
    table = profile.frequency_table(df, ["v"], 2000)
    assert table.count() == 2000 and table.agg({"position": "max"}).first()[0] == 2000
    assert rows(table.where("position <= 3"), "value", "n") == [("0", 2), ("1", 2), ("10", 2)]


def test_too_many_labels_raise(spark):
    df = spark.range(20).selectExpr("CAST(id AS STRING) AS v")
    assert features.string_index(df, ["v"], max_labels=20).count() == 20
    with pytest.raises(ValueError, match="frequency_index"):
        features.string_index(df, ["v"], max_labels=19)
