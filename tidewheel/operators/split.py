"""Reproducible train/test split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_bucket(keys: Sequence[str], seed: int = 42, buckets: int = 10) -> Column:
    """Bucket 0..buckets-1 of a row, a function of its key and the seed only."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % buckets


def hash_split(
    df: DataFrame, keys: Sequence[str], train_share: float = 0.7, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; unlike ``randomSplit`` independent of partitioning."""
    in_train = _in_train(keys, train_share, seed)
    return df.where(in_train), df.where(~in_train)


def with_split(df: DataFrame, keys: Sequence[str], train_share: float = 0.7, seed: int = 42) -> DataFrame:
    """Tag every row 'train' or 'test', by the same rule as :func:`hash_split`."""
    return df.withColumn("part", F.when(_in_train(keys, train_share, seed), "train").otherwise("test"))


def _in_train(keys: Sequence[str], train_share: float, seed: int) -> Column:
    return split_bucket(keys, seed, 1000) < round(train_share * 1000)
