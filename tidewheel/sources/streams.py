"""Streaming message sources: frames with a ``value`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_messages(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest", **options) -> DataFrame:
    """Subscribe to one topic. Needs Spark's Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**options)
        .load()
    )


def text_messages(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Each line of the files that appear in a folder as one message."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)
