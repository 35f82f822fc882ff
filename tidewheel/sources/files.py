"""CSV and parquet, always with an explicit schema for CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str, null_token: str = "NA", multi_line: bool = False
) -> DataFrame:
    """Read CSV with a header. No inference: types must not depend on the data read.

    Texts with line breaks need ``multi_line``, which keeps Spark from splitting files: leave it off for large raw files.
    """
    return spark.read.schema(schema).csv(path, header=True, nullValue=null_token, multiLine=multi_line)


def write_csv(
    df: DataFrame, path: str, null_token: str = "NA", single_file: bool = False, multi_line: bool = False
) -> None:
    """Overwrite as CSV with a header. ``single_file`` is for small result tables only.

    A text with a line break would be torn by a reader that splits files: it raises an error unless ``multi_line`` says
    that the file will be read with that option.
    """
    out = df.coalesce(1) if single_file else df
    if not multi_line:
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
        torn = F.raise_error(F.lit("text with a line break: write and read with multi_line=True"))
        out = out.withColumns({c: F.when(F.col(c).rlike("[\\r\\n]"), torn).otherwise(F.col(c)) for c in texts})
    out.write.mode("overwrite").csv(path, header=True, nullValue=null_token)


def read_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> list[DataFrame]:
    """The parquet tables ``<folder>/<name>.parquet``."""
    return [spark.read.parquet(f"{folder}/{name}.parquet") for name in names]


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), max_records_per_file: int | None = None
) -> None:
    """Overwrite as parquet, written by all tasks in parallel."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


_ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row's place in its partition in the low 33 bits


def preview(df: DataFrame, rows: int = 1000, parts: int = 64) -> tuple[list[Row], int]:
    """The first rows and the full row count of a query, which runs once; nothing is stored.

    One aggregate keeps both: every task counts, and those of the first ``parts`` partitions also pass on their first
    ``rows`` rows, so no more than rows x parts meet. Only if these partitions hold fewer rows than asked for, and
    later ones have some, the rows are taken by a second run, which stops as soon as it has enough.
    """
    row_id = F.col("_row_id")
    early = (F.shiftright(row_id, 33) < parts) & (row_id.bitwiseAND(F.lit(_ROW_BITS)) < rows)
    kept = F.collect_list(F.when(early, F.struct(row_id.alias("at"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))))
    in_order = F.array_sort(kept, lambda a, b: F.when(a["at"] < b["at"], -1).otherwise(1))  # rows may hold maps
    numbered = df.withColumn("_row_id", F.monotonically_increasing_id())
    found = numbered.agg(F.count(F.lit(1)).alias("n"), F.slice(in_order, 1, max(rows, 1)).alias("kept")).first()
    head = [r["row"] for r in found["kept"]][:rows]
    return (head if len(head) >= min(rows, found["n"]) else df.take(rows)), found["n"]
