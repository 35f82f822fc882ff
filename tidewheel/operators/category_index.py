"""A category index that is a stored table: fitted, saved and joined, for columns with any number of values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import materialise
from .ordered import dim_id

# A value is frequent if it has more than this part of all rows: so no more than so many values are broadcast.
FREQUENT_VALUES = 1_000
SALTS = 64
_ATOMIC = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


@dataclass
class CategoryIndex:
    """Values of one column by falling frequency in training, ties by value: ``value, index, frequent, salt``.

    The same numbers as a fitted string indexer, but the values stay in a table and never reach the driver.
    """

    column: str
    table: DataFrame

    def transform(self, df: DataFrame, name: str) -> DataFrame:
        """Add the index as ``name``; null for a null or a value that training has not met. Rows are kept, also in streams.

        Frequent values are broadcast, FREQUENT_VALUES at most. Their rows, and those without a value, need no partner in
        the join with the rest of the table, and carry a salt that spreads them over its partitions: no value is hot there.
        """
        frequent = self.table.where("frequent").select(F.col("value").alias("_value"), F.col("index").alias("_first"))
        rest = self.table.where("NOT frequent").select(
            F.col("value").alias("_value"), F.col("index").alias("_second"), F.col("salt").alias("_salt")
        )
        given = df.columns
        plain = [f.name for f in df.schema.fields if isinstance(f.dataType, _ATOMIC)]
        spread = F.pmod(F.xxhash64(*plain), F.lit(SALTS)).cast("int") + 1
        settled = F.col("_first").isNotNull() | F.col(self.column).isNull()
        met = df.join(F.broadcast(frequent), F.col(self.column) == F.col("_value"), "left").drop("_value")
        met = met.withColumn("_row_salt", F.when(settled, spread).otherwise(0))
        found = met.join(rest, (F.col(self.column) == F.col("_value")) & (F.col("_row_salt") == F.col("_salt")), "left")
        return found.select(*given, F.coalesce("_first", "_second").alias(name))

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, column: str, path: str) -> CategoryIndex:
        return cls(column, spark.read.parquet(path))


def fit_category_index(df: DataFrame, column: str, frequent_values: int = FREQUENT_VALUES) -> CategoryIndex:
    """Count, number and store the values of a column; nulls get no number. Runs jobs."""
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    values = materialise(values, "values")
    total = values.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    numbered = dim_id(values, [F.desc("n"), F.col("value")], "id")
    table = numbered.select(
        "value",
        (F.col("id") - 1).cast("double").alias("index"),
        (F.col("n") * frequent_values > total).alias("frequent"),
        F.lit(0).alias("salt"),  # stored: as a constant it would not be a join key
    )
    return CategoryIndex(column, materialise(table, "category-index"))
