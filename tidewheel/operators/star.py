"""Star and galaxy schemas: shared dimensions, facts with surrogate keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import season_of
from ..scratch import materialise, materialise_bucketed
from .ordered import dense_id, dim_id


def entity_dim(df: DataFrame, column: str, key: str) -> DataFrame:
    """Distinct non-null values of a column, numbered in their order."""
    return dim_id(df.select(column).where(F.col(column).isNotNull()).distinct(), [column], key)


def date_dim(df: DataFrame, column: str, key: str = "date_id") -> DataFrame:
    """Distinct dates with year, month, quarter and season, numbered in their order."""
    dates = df.select(F.to_date(column).alias("full_date")).where(F.col("full_date").isNotNull()).distinct()
    return dim_id(dates, ["full_date"], key).withColumns(
        {
            "year": F.year("full_date"),
            "month": F.month("full_date"),
            "quarter": F.quarter("full_date"),
            "season": season_of(F.month("full_date")),
        }
    )


@dataclass
class Galaxy:
    """Two shared dimensions and any number of facts over the same records."""

    entity: DataFrame
    dates: DataFrame
    facts: dict[str, DataFrame]

    def tables(self) -> dict[str, DataFrame]:
        return {"entity_dim": self.entity, "date_dim": self.dates, **self.facts}

    def stored(self, buckets: int | None = None) -> Galaxy:
        """The same schema with its facts written once, all bucketed alike by ``record_id``, for several queries over them.

        Facts of one galaxy then join by their records without a shuffle (with a merge hint even where Spark would broadcast
        one). There are as many buckets as shuffle partitions unless told otherwise. Runs jobs.
        """
        spark = self.entity.sparkSession
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        facts = {n: materialise_bucketed(f, "record_id", buckets, n.replace("_", "-")) for n, f in self.facts.items()}
        return Galaxy(self.entity, self.dates, facts)

    def join_facts(self, first: str, second: str) -> DataFrame:
        """Two stored facts side by side, one row for each record; key columns of the second are left out."""
        right = self.facts[second].drop("entity_id", "date_id")
        return self.facts[first].hint("merge").join(right, "record_id")

    def register(self) -> None:
        """Make every table available to SQL."""
        for name, table in self.tables().items():
            table.createOrReplaceTempView(name)


def galaxy_schema(
    df: DataFrame,
    entity: str,
    date: str,
    tie_break: Sequence[str],
    facts: Mapping[str, Sequence[str]],
) -> Galaxy:
    """Split one flat table into an entity and a date dimension and several facts.

    Records are numbered by (date, entity, tie_break), which must be unique. A record
    without entity is left out, one without date keeps a null ``date_id``. The input is
    evaluated once and its needed columns are stored; dimensions and numbers come from there, and all
    facts read the one stored, numbered table and only their own columns of it. Runs jobs.
    """
    measures = list(dict.fromkeys(c for cols in facts.values() for c in cols))
    rows = materialise(
        df.select(entity, F.to_date(date).alias("full_date"), *dict.fromkeys([*measures, *tie_break])), "records"
    )
    numbered = dense_id(rows.where(F.col(entity).isNotNull()), ["full_date", entity, *tie_break], "record_id")
    entities = entity_dim(rows, entity, "entity_id")
    dates = date_dim(rows, "full_date")
    keyed = numbered.join(entities, entity).join(dates.select("full_date", "date_id"), "full_date", "left")
    return Galaxy(
        entities, dates, {n: keyed.select("record_id", "entity_id", "date_id", *cols) for n, cols in facts.items()}
    )


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Store a fact bucketed and sorted by its key: facts saved alike join without a shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)
