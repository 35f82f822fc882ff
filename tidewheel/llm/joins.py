"""Join helpers shared by the operators of this package."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.scratch import materialise, scratch_path

BROADCAST_IDS = 1_000_000


def stored_ids(df: DataFrame, column: str) -> DataFrame:
    """The distinct non-null values of a column, written once."""
    return materialise(df.select(column).where(F.col(column).isNotNull()).distinct(), "ids")


def keep_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` whose key is in the stored table ``ids``.

    The id list is counted: up to BROADCAST_IDS numbers (some 8 MB) are broadcast, which
    spares a shuffle of ``df``; a longer list is joined by an ordinary shuffle.
    """
    small = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if small else ids, column, "left_semi")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder, and let Spark drop the shuffle files of finished steps.

    A stored table needs no lineage, but Spark frees a shuffle's files only when the driver's garbage
    collector has met it, which on a driver with little to do may be never. So it is asked to, before
    a step that makes new files and after it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    _collect(df)
    df.write.option("compression", "zstd").parquet(path)
    _collect(df)
    return spark.read.schema(df.schema).parquet(path)


def _collect(df: DataFrame) -> None:
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def discard(stored: DataFrame) -> None:
    """Delete a stored table that no later step reads."""
    files = stored.inputFiles()
    if not files:
        return
    context = stored.sparkSession.sparkContext
    file = context._jvm.org.apache.hadoop.fs.Path(files[0])
    file.getFileSystem(context._jsc.hadoopConfiguration()).delete(file.getParent(), True)
