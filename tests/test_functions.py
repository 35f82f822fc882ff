import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewheel.functions import (
    band,
    conditional_percent,
    matched_format,
    parse_date,
    percent_where,
    safe_numeric,
    season_of,
    tag,
    value_or_default,
)


def _apply(spark, values, type_name, *functions):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {type_name}")
    return [tuple(r)[1:] for r in df.select("i", *[f(F.col("x")) for f in functions]).orderBy("i").collect()]


def test_dates_of_every_format_and_the_format_used(spark):
    texts = ["2008-02-01", "31/12/2008", "12/31/2008", "1/2/2008", "1/31/2008", "2008/02/01", "01-02-2008", "bad", "", None]
    feb1 = dt.date(2008, 2, 1)
    assert _apply(spark, texts, "string", parse_date, matched_format) == [
        (feb1, "yyyy-MM-dd"),
        (dt.date(2008, 12, 31), "dd/MM/yyyy"),
        (dt.date(2008, 12, 31), "MM/dd/yyyy"),
        (feb1, "d/M/yyyy"),  # ambiguous: day first
        (dt.date(2008, 1, 31), "M/d/yyyy"),
        (feb1, "yyyy/MM/dd"),
        (feb1, "dd-MM-yyyy"),
        (None, None),
        (None, None),
        (None, None),
    ]


def test_impossible_dates_are_null(spark):
    assert _apply(spark, ["2023-02-30", "2023-13-01", "00/01/2023"], "string", parse_date) == [(None,)] * 3


def test_the_shape_check_changes_no_result(spark):
    texts = ["2008-2-1", "+12008-02-01", " 2008-02-01", "2008-02-01 ", "2008-02-01T00:00", "01/02/08", "1/02/2008", "001/2/2008"]
    for fmt in ("yyyy-MM-dd", "dd/MM/yyyy", "d/M/yyyy", "M/d/yyyy"):
        plain = _apply(spark, texts, "string", lambda c: F.try_to_date(c, fmt).cast("string"))
        assert _apply(spark, texts, "string", lambda c: parse_date(c, [fmt]).cast("string")) == plain


def test_a_format_without_known_shape_is_still_tried(spark):
    assert _apply(spark, ["1 Feb 2008"], "string", lambda c: parse_date(c, ["d MMM yyyy"])) == [(dt.date(2008, 2, 1),)]


def test_seasons_and_null_month(spark):
    got = _apply(spark, [12, 1, 3, 6, 9, 11, None], "int", season_of)
    assert [g[0] for g in got] == ["Summer", "Summer", "Autumn", "Winter", "Spring", "Spring", None]


def test_safe_numeric(spark):
    assert _apply(spark, ["1.5", "NA", "", None, "-3"], "string", safe_numeric) == [(1.5,), (None,), (None,), (None,), (-3.0,)]


def test_value_or_default(spark):
    check = lambda c: value_or_default(c, ["N", "S"], "N")
    assert _apply(spark, ["S", "x", None], "string", check) == [("S",), ("N",), ("N",)]


def test_band(spark):
    labels = ["high", "mid", "low", "else"]
    cut = lambda c: band(c, [(">", 5), (">", 2), (">=", 0)], labels)
    got = _apply(spark, [5.1, 5.0, 2.0, 0.0, -0.1, None], "double", cut)
    assert [g[0] for g in got] == ["high", "mid", "low", "low", "else", "else"]
    with pytest.raises(ValueError):
        band(F.lit(1), [(">", 1)], ["one"])


def test_tag(spark):
    assert _apply(spark, [1, 2], "int", lambda c: tag(c, {1: "one"})) == [("one",), (None,)]


def test_percentages(spark):
    df = spark.createDataFrame([(True, True), (True, False), (False, None), (None, True)], "a boolean, b boolean")
    row = df.agg(percent_where(F.col("a")), conditional_percent(F.col("b"), F.col("a"))).first()
    assert tuple(row) == (50.0, 50.0)
    assert df.where("a = false").agg(conditional_percent(F.col("b"), F.col("a"))).first()[0] is None
