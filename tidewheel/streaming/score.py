"""Scoring a stream of change-data messages."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.clean import add_differences, apply_domains, drop_null_keys, parse_dates
from ..operators.features import FeatureModel
from ..sources.jdbc import write_jdbc
from .cdc import cdc_unwrap


def prepare_rows(
    df: DataFrame,
    date_column: str | None = None,
    differences: Mapping[str, tuple[str, str]] | None = None,
    domains: Mapping[str, tuple[Sequence, object]] | None = None,
) -> DataFrame:
    """Stateless features, defined once for training, batch scoring and streaming."""
    out = parse_dates(df, date_column, source_format=None) if date_column else df
    if differences:
        out = add_differences(out, differences)
    return apply_domains(out, domains) if domains else out


@dataclass
class Scorer:
    """Everything between a change message and its prediction, for batch and stream alike."""

    schema: StructType
    features: FeatureModel
    model: Model
    prepare: Callable[[DataFrame], DataFrame]
    required: Sequence[str]

    def score(self, messages: DataFrame, counted: bool = False) -> DataFrame:
        """Message fields plus ``prediction``. ``counted`` observes how many rows pass each step.

        Counting also spares work: filters are not pushed below a count, and otherwise those on derived fields would parse
        the message again for every condition.
        """
        count = F.count(F.lit(1)).alias("n")
        changes = cdc_unwrap(messages, self.schema)
        if counted:
            kinds = [F.count_if(F.col("change") == kind).alias(kind) for kind in ("delete", "invalid")]
            changes = changes.observe("received", count, *kinds)
        rows = drop_null_keys(self.prepare(changes.where(F.col("change") == "upsert")), self.required)
        rows = rows.observe("valid", count) if counted else rows
        scored = self.model.transform(self.features.transform(rows))
        scored = scored.select(*self.schema.fieldNames(), "prediction")
        return scored.observe("scored", count) if counted else scored

    def start(
        self, messages: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = False
    ) -> StreamingQuery:
        """Score a stream; ``sink`` is called once per micro-batch with its rows and its id.

        The sink is the only action on a batch and its errors are not caught: a failed
        batch leaves its offsets uncommitted and is tried again.
        """
        writer = (
            self.score(messages, counted=True)
            .writeStream.foreachBatch(sink)
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
        )
        return (writer.trigger(availableNow=True) if available_now else writer).start()


def batch_counts(query: StreamingQuery) -> list[dict[str, int]]:
    """Rows received, deleted, invalid, valid and scored of the recent micro-batches.

    ``valid`` minus ``scored`` is what the feature model skipped; an empty batch shows
    as zeros. The counts come from the one pass that wrote the batch.
    """
    counts = []
    for progress in query.recentProgress:
        seen = progress.observedMetrics
        if "received" in seen:
            counts.append(
                {
                    "batch_id": progress.batchId,
                    "received": seen["received"]["n"],
                    "deleted": seen["received"]["delete"],
                    "invalid": seen["received"]["invalid"],
                    "valid": seen["valid"]["n"],
                    "scored": seen["scored"]["n"],
                }
            )
    return counts


PUBLISHED = "_published"  # names with an underscore are no data to a reader of the folder
_PUBLISHED_SCHEMA = "batch_id long, try string, published timestamp"


def parquet_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Write each batch to a folder of its own, then publish it; :func:`read_scored` sees published batches only.

    Every try at a batch has its own folder and nothing is replaced in place, so a reader sees a batch as it was or as it
    is, never half of it. One line, added as one file, publishes a try and takes the place of an earlier one.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        name = f"t{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(f"{path}/batch_id={batch_id}/try={name}")
        publish(df.sparkSession, path, batch_id, name)

    return write


def publish(spark: SparkSession, path: str, batch_id: int, name: str) -> None:
    """Make a finished try the one that readers take."""
    line = spark.range(1).select(
        F.lit(batch_id).cast("long").alias("batch_id"), F.lit(name).alias("try"), F.current_timestamp().alias("published")
    )
    line.coalesce(1).write.mode("append").parquet(f"{path}/{PUBLISHED}")


def published_tries(spark: SparkSession, path: str) -> DataFrame:
    """``batch_id`` and ``try`` of the try to read, for every published batch."""
    lines = spark.read.schema(_PUBLISHED_SCHEMA).parquet(f"{path}/{PUBLISHED}")
    return lines.groupBy("batch_id").agg(F.max_by("try", F.struct("published", "try")).alias("try"))


def jdbc_sink(url: str, table: str, properties: Mapping[str, str]) -> Callable[[DataFrame, int], None]:
    """Append each batch with its id. At least once: read through ``latest_batch``."""
    return lambda df, batch_id: write_jdbc(df, url, table, properties, batch_id)


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    """All published batches, with their ``batch_id``. Folders of tries that were never published are pruned."""
    stored = spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("long"))
    return stored.join(published_tries(spark, path), ["batch_id", "try"], "left_semi").drop("try")
