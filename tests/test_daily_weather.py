"""The whole road on an invented weather table: CSV, cleaning, reports, models, stream."""

import json

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from helpers import by, rows
from tidewheel.plans import daily_weather as weather
from tidewheel.sources import text_messages, write_csv
from tidewheel.streaming import parquet_sink, read_scored

DAYS = 1400


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("weather") / "csv")
    noise = lambda k, m: F.pmod(F.xxhash64(F.lit(k), "place", "day"), F.lit(m))
    direction = lambda k: F.array(*map(F.lit, weather.COMPASS))[noise(k, 16).cast("int")]
    date = F.date_add(F.lit("2011-01-01").cast("date"), F.col("day").cast("int"))
    wet, next_wet = (F.pmod(F.xxhash64("place", F.col("day") + d), F.lit(10)) < 3 for d in (0, 1))
    df = (
        spark.range(DAYS)
        .select(F.col("id").alias("day"), F.explode(F.array(*map(F.lit, ["Sydney", "Cobar", "Albury"]))).alias("place"))
        .select(
            F.when(F.col("day") % 2 == 0, date.cast("string")).otherwise(F.date_format(date, "dd/MM/yyyy")).alias("Date"),
            F.col("place").alias("Location"),
            (noise("a", 150) / 10).alias("MinTemp"),
            (15 + noise("b", 200) / 10).alias("MaxTemp"),
            F.when(wet, 1 + noise("c", 300) / 10).otherwise(0.0).alias("Rainfall"),
            F.lit(None).cast("double").alias("Evaporation"),
            F.lit(None).cast("double").alias("Sunshine"),
            F.when(noise("d", 20) > 0, direction("e")).alias("WindGustDir"),
            (20 + noise("f", 60)).cast("int").alias("WindGustSpeed"),
            direction("g").alias("WindDir9am"),
            direction("h").alias("WindDir3pm"),
            noise("i", 30).cast("int").alias("WindSpeed9am"),
            noise("j", 30).cast("int").alias("WindSpeed3pm"),
            (30 + noise("k", 70)).cast("int").alias("Humidity9am"),
            F.when(next_wet, 60 + noise("l", 40)).otherwise(20 + noise("l", 60)).cast("int").alias("Humidity3pm"),
            (1000 + noise("m", 300) / 10).alias("Pressure9am"),
            F.when(noise("n", 15) > 0, 1000 + noise("o", 300) / 10).alias("Pressure3pm"),
            F.lit(None).cast("int").alias("Cloud9am"),
            F.lit(None).cast("int").alias("Cloud3pm"),
            (10 + noise("p", 150) / 10).alias("Temp9am"),
            (12 + noise("q", 200) / 10).alias("Temp3pm"),
            F.when(wet, "Yes").otherwise("No").alias("RainToday"),
            F.when(noise("r", 25) > 0, F.when(next_wet, "Yes").otherwise("No")).alias("RainTomorrow"),
        )
    )
    write_csv(df, path)
    return weather.read_raw(spark, path).cache()


@pytest.fixture(scope="module")
def table(raw):
    return weather.cleaned(raw).cache()


def test_cleaned_rows_have_no_gaps(raw, table):
    assert table.count() == raw.where("RainTomorrow IS NOT NULL").count() < 3 * DAYS
    kept = [c for c in table.columns if c != "Date"]
    assert set(weather.SPARSE).isdisjoint(table.columns)
    assert table.select(*[F.count_if(F.col(c).isNull()) for c in kept]).first() == tuple([0] * len(kept))


def test_the_galaxy_joins_back_to_the_table(table):
    schema = weather.galaxy(table)
    assert schema.entity.count() == 3 and schema.dates.count() <= DAYS
    joined = schema.facts["weather_fact"].join(schema.facts["wind_pressure_fact"].drop("entity_id", "date_id"), "record_id")
    joined = joined.join(schema.entity, "entity_id").join(schema.dates, "date_id")
    columns = ["Location", "Rainfall", "Pressure3pm", "RainTomorrow"]
    assert rows(joined.select("full_date", *columns)) == rows(table.select("date_parsed", *columns))


def test_all_reports_give_rows(table):
    results = {name: df.collect() for name, df in weather.reports(table).items()}
    assert len(results) == 10
    assert {n for n, r in results.items() if not r} <= {"dry_spells"}
    assert sum(r["n"] for r in results["wet_and_dry_years"]) == table.count()
    assert {r["Location"] for r in results["seasons"]} == {"Sydney", "Cobar"}
    assert [r["change_band"][0] for r in results["pressure_fall"]] == ["4", "3", "2", "1"]
    assert len(results["humidity_deciles"]) == 20
    assert {r["year_tag"] for r in results["year_to_date"]} == {"wet", "dry"}
    by_year = {}
    for r in results["year_to_date"]:
        by_year[r["year"]] = r["ytd_amount"]
    total = by(table.where("Location = 'Sydney'").groupBy("year").agg(F.sum("Rainfall").alias("s")), "year")
    assert by_year[2011] == pytest.approx(total[2011]["s"], abs=0.06)
    assert sorted(r["overall_rank"] for r in results["league"]) == [1, 2, 3]


def test_models_and_stream(spark, raw, tmp_path):
    models = {"Logistic Regression": LogisticRegression(featuresCol="scaled_features", maxIter=10)}
    comparison = weather.compare_models(raw, models=models)
    table = comparison.results.collect()
    assert {r["encoding"] for r in table} == {"index", "onehot"}
    assert min(r["roc_auc"] for r in table) > 0.7

    comparison.save_best(spark, f"{tmp_path}/best")
    schema = weather.stream_schema()
    assert len(schema.fieldNames()) == 18
    messages = raw.limit(200).select(
        F.monotonically_increasing_id().cast("int").alias("id"), *[c for c in raw.columns if c in schema.fieldNames()]
    )
    messages.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{tmp_path}/in")
    with open(f"{tmp_path}/in/extra.txt", "w") as out:
        out.write(json.dumps({"payload": {"after": {"id": 999, "Date": "nonsense", "Location": "Sydney", "MinTemp": 1.0}}}))
    scorer = weather.scorer(*comparison.best())
    query = scorer.start(text_messages(spark, f"{tmp_path}/in"), parquet_sink(f"{tmp_path}/out"), f"{tmp_path}/o", True)
    query.awaitTermination()
    scored = read_scored(spark, f"{tmp_path}/out")
    assert scored.count() == 200 and scored.where("id = 999 OR prediction IS NULL").count() == 0
