"""Session builder with the settings every operator here assumes."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC dates, runtime re-planning with skew handling, no LEGACY date parser.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


MAX_SHUFFLE_PARTITIONS = 20_000


def cluster_conf(
    input_bytes: int, cores: int, partition_bytes: int = 200 << 20, scan_bytes: int = 512 << 20
) -> dict[str, str]:
    """Partition sizes for an input of the given size.

    Shuffle partitions aim at ``partition_bytes``, but there are no more than five for each
    core, and MAX_SHUFFLE_PARTITIONS at most: an exchange has as many blocks as map tasks
    times partitions, and the driver holds a status for each map task. Beyond that partitions
    grow, and sorts and aggregates spill. AQE merges those that turn out small. Scans are split by
    ``scan_bytes``, apart from shuffles. Range-partitioned slices follow the shuffle partitions.
    """
    wanted = -(-input_bytes // partition_bytes)
    partitions = max(min(wanted, 5 * cores, MAX_SHUFFLE_PARTITIONS), min(2 * cores, MAX_SHUFFLE_PARTITIONS))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(scan_bytes if wanted > partitions else partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
    }


def build_session(app_name: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Return a session. ``master`` stays unset on a cluster (spark-submit supplies it)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(app_name: str, cores: int = 8, conf: dict[str, str] | None = None) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    local = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": "8g",
    }
    spark = build_session(app_name, f"local[{cores}]", {**local, **(conf or {})})
    spark.sparkContext.setLogLevel("ERROR")
    return spark
