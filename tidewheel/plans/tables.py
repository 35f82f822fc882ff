"""Input tables and the imperfect variants of them that cleaning and profiling run on.

A variant is a list of SQL expressions both engines read alike, so that query and
check start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NULLED_EVENTS = [
    "event_id",
    "ts",
    "user_id",
    "CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS event_type",
    "CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS value",
    "CASE WHEN event_id % 2 = 0 THEN NULL ELSE props END AS props",
    "CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(event_id % 9 AS INT) END AS level",
    "CAST(NULL AS DOUBLE) AS nothing",
]
NULLED_EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props", "level", "nothing"]
NULLED_EVENTS_SQL = f"nulled AS (SELECT {', '.join(NULLED_EVENTS)} FROM events)"

# A lineitem row has no key of its own; these columns together identify one.
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def nulled_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(*NULLED_EVENTS)


def order_nations(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their customer and nation. Spark broadcasts the sides it measures as small."""
    return (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )


def line_nations(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with order, customer and nation."""
    lines = table(spark, folder, "lineitem")
    return lines.join(order_nations(spark, folder), F.col("l_orderkey") == F.col("o_orderkey"))


ORDER_NATIONS_SQL = """orders
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey"""
LINE_NATIONS_SQL = """lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey"""


def season_sql(month: str) -> str:
    return f"""CASE WHEN {month} IN (12, 1, 2) THEN 'Summer' WHEN {month} IN (3, 4, 5) THEN 'Autumn'
        WHEN {month} IN (6, 7, 8) THEN 'Winter' WHEN {month} IN (9, 10, 11) THEN 'Spring' END"""
