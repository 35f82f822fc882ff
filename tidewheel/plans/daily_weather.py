"""The operators set up for a table of daily weather observations per location.

From raw CSV to reports, compared models and a scoring stream. It doubles as an
example of how to configure the library for a table of one's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import band, season_of
from ..operators import analytics, clean
from ..operators.models import Comparison, model_compare
from ..operators.split import hash_split
from ..operators.star import Galaxy, galaxy_schema
from ..sources import read_csv
from ..streaming import Scorer, prepare_rows

# Columns of the raw table and of the stream messages.
RAW_COLUMNS = {
    "Date": "string",
    "Location": "string",
    "MinTemp": "double",
    "MaxTemp": "double",
    "Rainfall": "double",
    "Evaporation": "double",
    "Sunshine": "double",
    "WindGustDir": "string",
    "WindGustSpeed": "int",
    "WindDir9am": "string",
    "WindDir3pm": "string",
    "WindSpeed9am": "int",
    "WindSpeed3pm": "int",
    "Humidity9am": "int",
    "Humidity3pm": "int",
    "Pressure9am": "double",
    "Pressure3pm": "double",
    "Cloud9am": "int",
    "Cloud3pm": "int",
    "Temp9am": "double",
    "Temp3pm": "double",
    "RainToday": "string",
    "RainTomorrow": "string",
}
SPARSE = ["Evaporation", "Sunshine", "Cloud9am", "Cloud3pm"]
CATEGORICAL = ["Location", "WindGustDir", "WindDir9am", "WindDir3pm", "RainToday"]
NOT_IN_STREAM = [*SPARSE, "Temp9am", "RainTomorrow"]
DIFFERENCES = {
    "TempRange": ("MaxTemp", "MinTemp"),
    "HumidityDiff": ("Humidity9am", "Humidity3pm"),
    "PressureDiff": ("Pressure9am", "Pressure3pm"),
    "WindSpeedDiff": ("WindSpeed3pm", "WindSpeed9am"),
}
# MaxTemp, Temp9am and Pressure3pm are left out: each is highly correlated with a kept feature.
NUMERIC_FEATURES = [
    "MinTemp", "Temp3pm", "TempRange", "Rainfall", "Humidity9am", "Humidity3pm", "HumidityDiff", "Pressure9am",
    "PressureDiff", "WindGustSpeed", "WindSpeed9am", "WindSpeed3pm", "WindSpeedDiff", "month",
]
COMPASS = ["N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE", "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW"]
FOUR_CLIMATES = ["Darwin", "Sydney", "Melbourne", "Cobar"]

RAW_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in RAW_COLUMNS.items())


def stream_schema() -> T.StructType:
    """An id and the raw columns known on the day itself."""
    fields = {"id": "int", **{n: k for n, k in RAW_COLUMNS.items() if n not in NOT_IN_STREAM}}
    return T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in fields.items()))


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, RAW_SCHEMA, "NA")


def labelled(raw: DataFrame) -> DataFrame:
    """Rows with a label, typed dates, without the columns that are mostly missing."""
    known = clean.drop_sparse_columns(clean.drop_null_keys(raw, ["RainTomorrow"]), columns=SPARSE)
    return clean.parse_dates(known, "Date", source_format=None)


def cleaned(raw: DataFrame) -> DataFrame:
    """Labelled rows with medians and modes for what is missing: the table the reports read."""
    known = labelled(raw)
    numeric = [n for n, kind in RAW_COLUMNS.items() if kind != "string" and n not in SPARSE]
    return clean.impute(known, numeric, CATEGORICAL)


def galaxy(table: DataFrame) -> Galaxy:
    """Location and date dimensions shared by a weather and a wind and pressure fact."""
    return galaxy_schema(
        table,
        "Location",
        "date_parsed",
        [],  # one row per location and day
        {
            "weather_fact": [
                "MinTemp", "MaxTemp", "Rainfall", "Humidity9am", "Humidity3pm", "Temp9am", "Temp3pm", "RainToday",
                "RainTomorrow",
            ],
            "wind_pressure_fact": [
                "WindGustDir", "WindGustSpeed", "WindDir9am", "WindDir3pm", "WindSpeed9am", "WindSpeed3pm",
                "Pressure9am", "Pressure3pm",
            ],
        },
    )


def reports(table: DataFrame) -> dict[str, DataFrame]:
    """The ten reports, lazily. They read the flat table: its rows hold both facts already.

    Reports that go by date leave out rows whose date could not be parsed.
    """
    rows = table.withColumn("season", season_of(F.col("month")))
    tomorrow = rows.where(F.col("RainTomorrow").isNotNull())
    dated, dated_tomorrow = (t.where(F.col("date_parsed").isNotNull()) for t in (rows, tomorrow))
    here = F.col("Location").isin(FOUR_CLIMATES)
    rain, rain_next = F.col("RainToday") == "Yes", F.col("RainTomorrow") == "Yes"
    humidity, pressure = F.col("Humidity3pm"), F.col("Pressure3pm")
    return {
        "wet_and_dry_years": analytics.period_vs_mean(
            dated, {"year": F.col("year")}, rain, F.col("Rainfall"), 1.15, 0.85, ("wet", "dry", "normal")
        ),
        "seasons": analytics.rank_in_group(
            dated.where(here & F.col("RainToday").isNotNull()),
            "Location",
            "season",
            rain,
            {"mean_rainfall": (F.col("Rainfall"), 2), "mean_humidity": (humidity, 1)},
        ),
        "pressure_fall": analytics.lag_delta_buckets(
            dated_tomorrow.where(pressure.isNotNull()),
            ["Location"],
            ["date_parsed"],
            "Pressure3pm",
            rain_next,
            [(">", 5), (">", 2), (">=", 0)],
            ["4_sharp_fall", "3_fall", "2_stable", "1_rise"],
        ),
        "wind_direction": analytics.conditional_rate(
            tomorrow.where(here & F.col("WindGustDir").isNotNull()),
            ["Location", "WindGustDir"],
            rain_next,
            50,
            {"mean_gust": (F.col("WindGustSpeed"), 1)},
        ),
        "humidity_deciles": analytics.decile_rate(
            tomorrow.where(here & humidity.isNotNull()), ["Location"], "Humidity3pm", ["date_parsed"], rain_next
        ),
        "humidity_and_pressure": analytics.bucket_matrix(
            tomorrow.where(humidity.isNotNull() & pressure.isNotNull()),
            {
                "humidity_band": band(humidity, [(">=", 80), (">=", 50)], ["3_high", "2_mid", "1_low"]),
                "pressure_band": band(pressure, [("<", 1011), ("<", 1019)], ["1_low", "2_mid", "3_high"]),
            },
            rain_next,
            500,
        ),
        "year_to_date": analytics.ytd_running_sum(
            dated.where((F.col("Location") == "Sydney") & F.col("year").isin(2011, 2014)),
            ["Location"],
            "date_parsed",
            "Rainfall",
            {2011: "wet", 2014: "dry"},
        ),
        "dry_spells": analytics.longest_runs(dated, ["Location"], ["date_parsed"], F.col("RainToday") == "No", 50, 15),
        "persistence": analytics.persistence_rate(
            dated_tomorrow.where(here & F.col("RainToday").isNotNull()), ["Location", "season"], rain, rain_next, 100
        ),
        "league": analytics.league_table(
            dated,
            "Location",
            {
                "mean_max_temp": (F.col("MaxTemp"), 1),
                "mean_min_temp": (F.col("MinTemp"), 1),
                "mean_humidity": (humidity, 1),
                "mean_pressure": (pressure, 1),
                "mean_gust": (F.col("WindGustSpeed"), 1),
                "mean_rainfall": (F.col("Rainfall"), 2),
            },
            {"total_rainfall": (F.col("Rainfall"), 0)},
            rain_next,
        ),
    }


def prepare(df: DataFrame) -> DataFrame:
    """Features of raw rows. Values outside their domain become null and are imputed by the model."""
    domains = {c: (COMPASS, None) for c in ("WindGustDir", "WindDir9am", "WindDir3pm")}
    return prepare_rows(df, "Date", DIFFERENCES, {**domains, "RainToday": (["Yes", "No"], None)})


def compare_models(raw: DataFrame, **options) -> Comparison:
    """Both encodings and all three classifiers on a 70/30 split by location and date."""
    rows = prepare(labelled(raw)).withColumn("label", (F.col("RainTomorrow") == "Yes").cast("double"))
    train, test = hash_split(rows, ["Location", "Date"], 0.7, seed=42)
    return model_compare(train, test, NUMERIC_FEATURES, CATEGORICAL, "label", **options)


def scorer(features, model) -> Scorer:
    return Scorer(stream_schema(), features, model, prepare, required=["Location", "MinTemp", "month"])
