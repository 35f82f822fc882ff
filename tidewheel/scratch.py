"""Intermediate tables in the cluster's shared checkpoint folder.

A few operators need a frame frozen between two steps: range partitioning picks
its bounds by sampling, so planning the same frame twice would give different
slices. A written table fixes the rows, cuts the lineage, survives lost
executors and keeps column pruning for the second read.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_local_root: str | None = None
_written: list[str] = []
_tables: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the session; a local one only on a local master."""
    global _local_root
    configured = spark.conf.get(_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {_CONF} to a folder all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tidewheel-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path that nothing else uses."""
    path = f"{scratch_root(spark)}/tidewheel-{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once and return the stored table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_bucketed(df: DataFrame, key: str, buckets: int, label: str = "table", dealt: bool = False) -> DataFrame:
    """Write ``df`` once, one file for each bucket of ``key`` and sorted by it, and return the stored table.

    Tables with the same key and number of buckets join and group by it without a shuffle. Rows are first dealt to one task a
    bucket; ``dealt`` says that no two tasks hold the same key already, so they write what they have. The table is known to the
    session's catalog under a name of its own until :func:`release`.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    placed = df if dealt else df.repartition(buckets, key)  # as the writer deals rows: every task has one bucket
    placed.write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).saveAsTable(name)
    _tables.append(name)
    return spark.table(name)


def release(spark: SparkSession) -> int:
    """Delete every table written by this process; call it once results are consumed."""
    while _tables:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop()}")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed
