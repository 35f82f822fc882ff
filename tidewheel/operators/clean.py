"""Cleaning: typing, dropping, imputing."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import DATE_FORMATS, matched_format, parse_date, safe_numeric, value_or_default
from .quantiles import fit_quantiles


def drop_null_keys(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Remove rows in which any required column is null."""
    return df.na.drop(subset=list(required))


def sparse_columns(df: DataFrame, max_missing_percent: float) -> list[str]:
    """Names of columns whose share of nulls is at least the limit (one pass)."""
    names = df.columns
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(names)])
    counts = row.first()
    total = max(counts["n"], 1)
    return [c for i, c in enumerate(names) if 100.0 * counts[f"c{i}"] / total >= max_missing_percent]


def drop_sparse_columns(
    df: DataFrame, max_missing_percent: float = 30.0, columns: Sequence[str] | None = None
) -> DataFrame:
    """Drop the named columns, or those found to be missing too often."""
    return df.drop(*(columns if columns is not None else sparse_columns(df, max_missing_percent)))


def parse_dates(
    df: DataFrame,
    column: str,
    formats: Sequence[str] = DATE_FORMATS,
    parsed: str = "date_parsed",
    source_format: str | None = "date_format",
) -> DataFrame:
    """Add the parsed date with its year and month, and the format that fitted."""
    out = df.withColumn(parsed, parse_date(F.col(column), formats))
    out = out.withColumns({"year": F.year(parsed), "month": F.month(parsed)})
    return out.withColumn(source_format, matched_format(F.col(column), formats)) if source_format else out


def to_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast columns to double; text that is not a number becomes null."""
    return df.withColumns({c: safe_numeric(F.col(c)) for c in columns})


def apply_domains(df: DataFrame, domains: Mapping[str, tuple[Sequence, object]]) -> DataFrame:
    """Replace values outside ``column -> (allowed, default)`` by the default."""
    return df.withColumns({c: value_or_default(F.col(c), allowed, d) for c, (allowed, d) in domains.items()})


def add_differences(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add ``name -> (minuend, subtrahend)`` columns in one projection."""
    return df.withColumns({name: F.col(a) - F.col(b) for name, (a, b) in pairs.items()})


@dataclass
class FillValues:
    """Fitted imputation values, kept beside a model so that scoring uses the same ones."""

    numeric: dict[str, float] = field(default_factory=dict)
    categorical: dict[str, str] = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        """Fill nulls. A double filled into an integer column is truncated, as ``fillna`` does."""
        values = {c: v for c, v in {**self.numeric, **self.categorical}.items() if c in df.columns}
        return df.fillna(values) if values else df

    def save(self, spark: SparkSession, path: str) -> None:
        row = [(json.dumps(asdict(self)),)]
        spark.createDataFrame(row, "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FillValues:
        return cls(**json.loads(spark.read.text(path).first()["value"]))


def fit_fill_values(df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = ()) -> FillValues:
    """Medians of numeric and modes of categorical columns. Remove rows without a label first.

    A column with no value at all gets no fill value.
    """
    medians = {c: v[0] for c, v in fit_quantiles(df, numeric, [0.5]).items() if v[0] is not None}
    medians = {c: float(v) if isinstance(v, Decimal) else v for c, v in medians.items()}
    modes = {r["column"]: r["mode"] for r in modes_of(df, categorical).collect()} if categorical else {}
    return FillValues(medians, modes)


def modes_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent non-null value per column; the smallest value wins a tie.

    All columns are counted in one pass; counts, not rows, are shuffled.
    """
    counts = value_counts(df, columns).where(F.col("value").isNotNull())
    return counts.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("n"), "value")).alias("mode")
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for all columns in one pass; values as text, null included."""
    types = dict(df.dtypes)

    def text(c: str):
        """Both zeros are one value."""
        return (F.col(c) + F.lit(0.0).cast(types[c]) if types[c] in ("double", "float") else F.col(c)).cast("string")

    cells = F.array(*[F.struct(F.lit(c).alias("column"), text(c).alias("value")) for c in columns])
    return df.select(F.inline(cells)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def impute(df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = ()) -> DataFrame:
    """Fit and fill in one call."""
    return fit_fill_values(df, numeric, categorical).apply(df)
