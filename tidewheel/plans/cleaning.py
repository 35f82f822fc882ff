"""Cleaning, typing, change-data and file queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import clean
from ..scratch import scratch_path
from ..sources import preview, read_csv, write_csv, write_parquet
from ..streaming import cdc_unwrap as unwrap
from .tables import LINE_KEY, NULLED_EVENTS_SQL, nulled_events, table

DOMAIN = ["view", "click", "purchase"]
FILE_ROWS = 100  # every folder of the round trip holds more, at all test sizes


def drop_null_keys(spark, folder):
    return clean.drop_null_keys(nulled_events(spark, folder), ["event_type", "value"]).drop("nothing")


def _labelled(spark, folder):
    """Rows without a label go first, so that fill values come from labelled rows only."""
    return clean.drop_null_keys(nulled_events(spark, folder), ["event_type"])


def impute_median(spark, folder):
    return clean.impute(_labelled(spark, folder), numeric=["value", "level"]).select("event_id", "value", "level")


def impute_mode(spark, folder):
    nulled = nulled_events(spark, folder).select("event_id", "event_type", "props")
    return clean.impute(nulled, categorical=["event_type", "props"])


def parse_dates(spark, folder):
    form = F.col("event_id") % 5
    text = (
        F.when(form == 0, F.date_format("ts", "yyyy-MM-dd"))
        .when(form == 1, F.date_format("ts", "dd/MM/yyyy"))
        .when(form == 2, F.date_format("ts", "yyyy/MM/dd"))
        .when(form == 3, F.date_format("ts", "dd-MM-yyyy"))
        .otherwise("bad")
    )
    events = table(spark, folder, "events").select("event_id", text.alias("date_text"))
    return clean.parse_dates(events, "date_text")


def safe_numeric(spark, folder):
    text = F.when(F.col("event_id") % 11 == 0, "NA").otherwise(F.col("value").cast("string"))
    return clean.to_numeric(table(spark, folder, "events").select("event_id", text.alias("value")), ["value"])


def domain_default(spark, folder):
    nulled = nulled_events(spark, folder).select("event_id", "event_type")
    return clean.apply_domains(nulled, {"event_type": (DOMAIN, "view")})


def diff_features(spark, folder):
    pairs = {
        "discount_minus_tax": ("l_discount", "l_tax"),
        "price_minus_quantity": ("l_extendedprice", "l_quantity"),
        "order_minus_part": ("l_orderkey", "l_partkey"),
    }
    lines = table(spark, folder, "lineitem").select(*LINE_KEY, "l_extendedprice", "l_discount", "l_tax", "l_quantity")
    return clean.add_differences(lines, pairs).drop("l_discount", "l_tax", "l_quantity")


EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("event_date", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def event_messages(spark, folder):
    """Every event as a message: four envelopes, deletes, text that is no JSON, a wrong type."""
    events = table(spark, folder, "events").withColumn("event_date", F.date_format("ts", "yyyy-MM-dd"))
    row = F.to_json(F.struct(*EVENT_SCHEMA.fieldNames()))
    wrong = F.to_json(
        F.struct("event_id", "event_date", "user_id", "event_type", F.lit("oops").alias("value"))
    )
    form = F.col("event_id") % 7
    message = (
        F.when(form == 0, F.concat(F.lit('{"payload":{"after":'), row, F.lit(',"op":"c"}}')))
        .when(form == 1, F.concat(F.lit('{"payload":'), row, F.lit("}")))
        .when(form == 2, F.concat(F.lit('{"after":'), row, F.lit("}")))
        .when(form == 3, row)
        .when(form == 4, F.concat(F.lit('{"payload":{"before":'), row, F.lit(',"after":null,"op":"d"}}')))
        .when(form == 5, F.concat(F.lit("not json "), F.col("event_id")))
        .otherwise(wrong)
    )
    return events.select(message.cast("binary").alias("value"))


def cdc_unwrap(spark, folder):
    return unwrap(event_messages(spark, folder), EVENT_SCHEMA).drop("raw_value")


def parquet_roundtrip(spark, folder):
    """Orders written as parquet in a folder per status, with short files, and read back with the number of their file's rows."""
    path = scratch_path(spark, "parquet")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    write_parquet(orders, path, partition_by=["o_orderstatus"], max_records_per_file=FILE_ROWS)
    back = spark.read.parquet(path).withColumn("file", F.input_file_name())
    longest = back.groupBy("file").count().agg(F.max("count").alias("longest_file"))  # one row
    return back.drop("file").crossJoin(F.broadcast(longest)).withColumn("longest_file", F.least("longest_file", F.lit(FILE_ROWS + 1)))


def report_preview(spark, folder):
    """The first rows of a sorted report, each with the number of rows of the whole report."""
    report = table(spark, folder, "events").groupBy("user_id", "event_type").agg(F.round(F.avg("value"), 4).alias("mean_value"))
    report = report.orderBy("user_id", "event_type")
    first, total = preview(report, 25)
    return spark.createDataFrame([(*r, total) for r in first], f"{_shape(report)}, report_rows long")


def _shape(df):
    return ", ".join(f"{name} {kind}" for name, kind in df.dtypes)


def csv_roundtrip(spark, folder):
    """Customers with missing cells, written as CSV with the null token and read back."""
    source = table(spark, folder, "customer").withColumns(
        {
            "c_mktsegment": F.when(F.col("c_custkey") % 10 != 0, F.col("c_mktsegment")),
            "c_acctbal": F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")),
        }
    )
    path = scratch_path(spark, "csv")
    write_csv(source, path)
    return read_csv(spark, path, source.schema)


QUERIES = {
    "drop_null_keys": drop_null_keys,
    "impute_median": impute_median,
    "impute_mode": impute_mode,
    "parse_dates": parse_dates,
    "safe_numeric": safe_numeric,
    "domain_default": domain_default,
    "diff_features": diff_features,
    "cdc_unwrap": cdc_unwrap,
    "csv_roundtrip": csv_roundtrip,
    "parquet_roundtrip": parquet_roundtrip,
    "report_preview": report_preview,
}


def _mode_sql(column):
    return f"""(SELECT {column} FROM nulled WHERE {column} IS NOT NULL
            GROUP BY {column} ORDER BY COUNT(*) DESC, {column} LIMIT 1)"""


ORACLES = {
    "drop_null_keys": f"""
        WITH {NULLED_EVENTS_SQL} SELECT event_id, ts, user_id, event_type, value, props, level
        FROM nulled WHERE event_type IS NOT NULL AND value IS NOT NULL""",
    "impute_median": f"""
        WITH {NULLED_EVENTS_SQL}, labelled AS (SELECT * FROM nulled WHERE event_type IS NOT NULL)
        SELECT event_id, COALESCE(value, (SELECT quantile_disc(value, 0.5) FROM labelled)) AS value,
            COALESCE(level, (SELECT quantile_disc(level, 0.5) FROM labelled)) AS level FROM labelled""",
    "impute_mode": f"""
        WITH {NULLED_EVENTS_SQL} SELECT event_id, COALESCE(event_type, {_mode_sql("event_type")}) AS event_type,
            COALESCE(props, {_mode_sql("props")}) AS props FROM nulled""",
    "parse_dates": """
        WITH t AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m-%d')
                WHEN 1 THEN strftime(ts, '%d/%m/%Y') WHEN 2 THEN strftime(ts, '%Y/%m/%d')
                WHEN 3 THEN strftime(ts, '%d-%m-%Y') ELSE 'bad' END AS date_text FROM events),
        p AS (SELECT *, try_strptime(date_text, '%Y-%m-%d') AS a, try_strptime(date_text, '%d/%m/%Y') AS b,
                try_strptime(date_text, '%m/%d/%Y') AS c, try_strptime(date_text, '%Y/%m/%d') AS d,
                try_strptime(date_text, '%d-%m-%Y') AS e FROM t)
        SELECT event_id, date_text, CAST(COALESCE(a, b, c, d, e) AS DATE) AS date_parsed,
            CAST(year(COALESCE(a, b, c, d, e)) AS INTEGER) AS year,
            CAST(month(COALESCE(a, b, c, d, e)) AS INTEGER) AS month,
            CASE WHEN a IS NOT NULL THEN 'yyyy-MM-dd' WHEN b IS NOT NULL THEN 'dd/MM/yyyy'
                WHEN c IS NOT NULL THEN 'MM/dd/yyyy' WHEN d IS NOT NULL THEN 'yyyy/MM/dd'
                WHEN e IS NOT NULL THEN 'dd-MM-yyyy' END AS date_format FROM p""",
    "safe_numeric": """
        SELECT event_id, TRY_CAST(CASE WHEN event_id % 11 = 0 THEN 'NA' ELSE CAST(value AS VARCHAR) END AS DOUBLE)
            AS value FROM events""",
    "domain_default": f"""
        WITH {NULLED_EVENTS_SQL} SELECT event_id, CASE WHEN event_type IN ('view', 'click', 'purchase')
            THEN event_type ELSE 'view' END AS event_type FROM nulled""",
    "diff_features": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
            l_discount - l_tax AS discount_minus_tax, l_extendedprice - l_quantity AS price_minus_quantity,
            l_orderkey - l_partkey AS order_minus_part FROM lineitem""",
    "cdc_unwrap": """
        SELECT CASE event_id % 7 WHEN 4 THEN 'delete' WHEN 5 THEN 'invalid' ELSE 'upsert' END AS change,
            CASE WHEN event_id % 7 <> 5 THEN event_id END AS event_id,
            CASE WHEN event_id % 7 <> 5 THEN strftime(ts, '%Y-%m-%d') END AS event_date,
            CASE WHEN event_id % 7 <> 5 THEN user_id END AS user_id,
            CASE WHEN event_id % 7 <> 5 THEN event_type END AS event_type,
            CASE WHEN event_id % 7 < 5 THEN value END AS value FROM events""",
    "parquet_roundtrip": f"""
        SELECT o_orderkey, o_totalprice, o_orderdate, o_orderstatus, (SELECT LEAST(MAX(n), {FILE_ROWS}) FROM
            (SELECT COUNT(*) AS n FROM orders GROUP BY o_orderstatus)) AS longest_file FROM orders""",
    "report_preview": """
        WITH r AS (SELECT user_id, event_type, ROUND(AVG(value), 4) AS mean_value FROM events GROUP BY ALL)
        SELECT *, (SELECT COUNT(*) FROM r) AS report_rows FROM r ORDER BY user_id, event_type LIMIT 25""",
    "csv_roundtrip": """
        SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS c_acctbal,
            CASE WHEN c_custkey % 10 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer""",
}
