"""Safe typing and value checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_numeric(value: Column, type_name: str = "double") -> Column:
    """Cast, with null instead of an error for text that is not a number."""
    return value.try_cast(type_name)


def value_or_default(value: Column, allowed: Sequence, default) -> Column:
    """Keep a value of the allowed set; anything else, null included, becomes the default."""
    return F.when(value.isin(*allowed), value).otherwise(F.lit(default))
