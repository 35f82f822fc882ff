"""JDBC sink. Address and credentials come from the caller or the environment only."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def jdbc_options(env: Mapping[str, str] = os.environ, prefix: str = "JDBC_") -> tuple[str, dict[str, str]]:
    """URL and connection properties from ``JDBC_URL``, ``JDBC_USER``, ``JDBC_PASSWORD``, ``JDBC_DRIVER``."""
    names = {"USER": "user", "PASSWORD": "password", "DRIVER": "driver"}
    return env[f"{prefix}URL"], {key: env[prefix + n] for n, key in names.items() if prefix + n in env}


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], batch_id: int | None = None) -> None:
    """Append rows. Appends are at least once: pass ``batch_id`` and read through :func:`latest_batch`."""
    out = df if batch_id is None else df.withColumn("batch_id", F.lit(batch_id).cast("long"))
    out.write.jdbc(url=url, table=table, mode="append", properties=dict(properties))


def latest_batch(df: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per key, however often its batch was written.

    Several versions of a key in one batch are told apart by ``order`` (an offset or event time), the highest
    wins; versions equal in that too by their values, so that the same one is taken every time.
    """
    others = F.struct(*[c for c in df.columns if c != key])
    newest = F.struct("batch_id", *order, others.alias("_values"))
    return df.groupBy(key).agg(F.max_by(others, newest).alias("_row")).select(key, "_row.*")
