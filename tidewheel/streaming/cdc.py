"""Unwrapping change-data-capture envelopes; the same code for batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def cdc_unwrap(messages: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Turn messages into ``raw_value``, ``change`` and the fields of ``schema``.

    The row is looked for in ``payload.after``, ``payload``, ``after`` and the message
    itself. ``change`` is 'upsert', 'delete' (operation "d" in an object that also has
    ``before`` or ``after``: the fields are those of the row before, if given) or 'invalid' (no
    field could be read). A bare row may own a column ``op``; it is no operation.
    """
    raw = messages.selectExpr(f"CAST({value} AS STRING) AS raw_value")
    # Anything but an object is invalid; not parsing it avoids a costly error per path.
    json = F.when(F.col("raw_value").rlike(r"^\s*\{"), F.col("raw_value"))
    # One parse per level; nested objects stay text.
    outer = raw.withColumn("_json", json).withColumn(
        "_out", F.from_json("_json", "payload string, before string, after string, op string")
    )
    inner = outer.withColumn("_in", F.from_json("_out.payload", "before string, after string, op string"))

    def deletes(text: str, level: str) -> Column:
        enveloped = F.arrays_overlap(F.json_object_keys(text), F.array(F.lit("before"), F.lit("after")))
        return F.coalesce((F.col(f"{level}.op") == "d") & enveloped, F.lit(False))

    # "after" is null in a delete, so without the check the whole payload would pass for a row.
    is_delete = deletes("_out.payload", "_in") | deletes("_json", "_out")
    row = F.when(F.col("_deleted"), F.coalesce("_in.before", "_out.before")).otherwise(
        F.coalesce("_in.after", "_out.payload", "_out.after", "_json")
    )
    parsed = inner.withColumn("_deleted", is_delete).select(
        "raw_value", "_deleted", F.from_json(row, schema).alias("data")
    )
    # Compared as one struct: a test per field would multiply the optimizer's constraints.
    nothing = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    empty = F.col("data").isNull() | F.col("data").eqNullSafe(nothing)
    change = F.when(F.col("_deleted"), "delete").when(empty, "invalid").otherwise("upsert")
    return parsed.select("raw_value", change.alias("change"), "data.*")
