"""Data profiling: one row per column (or pair) out, one pass over the table in."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import materialise
from .clean import value_counts
from .quantiles import fit_quantiles

# Severity of a missing percentage (upper bound, exclusive).
SEVERITY = ((5, "Low Missing"), (30, "Moderate Missing"), (50, "High Missing"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _per_column(df: DataFrame, columns: Sequence[str], **measures) -> DataFrame:
    """Aggregate once and return a row per column; measures are functions of its name."""
    rows = F.array(
        *[F.struct(F.lit(c).alias("column"), *[m(c).alias(name) for name, m in measures.items()]) for c in columns]
    )
    return df.agg(rows.alias("rows")).select(F.inline("rows"))


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count and percentage of each column."""
    nulls = lambda c: F.count_if(F.col(c).isNull())
    return _per_column(
        df,
        columns or df.columns,
        missing=nulls,
        missing_pct=lambda c: F.round(nulls(c) / F.count(F.lit(1)) * 100, 2),
    )


def missing_severity(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing profile with a severity class, worst first."""
    pct = F.col("missing_pct")
    level = F.when(pct == 0, "No Missing")
    for bound, name in SEVERITY:
        level = level.when(pct < bound, name)
    return (
        missing_profile(df, columns)
        .withColumn("severity", level.otherwise("Critical Missing"))
        .orderBy(F.desc("missing_pct"), "column")
    )


def dup_profile(df: DataFrame, hash_bits: int = 64) -> DataFrame:
    """Rows, columns, distinct rows and surplus copies of whole rows.

    What is shuffled is a hash of each row with a count, two numbers in place of the row. A second hash, seeded otherwise, tells
    groups in which different rows have met; only those bring whole rows, by a second scan that is not made without them.
    (``hash_bits`` shortens the first hash, so that a test can force such groups.) Runs jobs.
    """
    if any(isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) for f in df.schema.fields):
        counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))  # nested zeros would hash by their sign
        sizes = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
        return _dup_row(df, *sizes)
    kinds = dict(df.dtypes)
    cells = [F.col(f"`{c}`") + F.lit(0.0).cast(k) if k in ("double", "float") else F.col(f"`{c}`") for c, k in kinds.items()]
    # A hash passes over nulls, so where they stand is hashed too.
    cells = [*cells, *[F.col(f"`{c}`").isNull() for c in kinds]]
    first = F.shiftrightunsigned(F.xxhash64(*cells), 64 - hash_bits) if hash_bits < 64 else F.xxhash64(*cells)
    keyed = df.select(first.alias("h"), F.xxhash64(F.lit("second"), *cells).alias("other"))
    groups = keyed.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("other").alias("low"), F.max("other").alias("high"))
    groups = groups.withColumn("met", F.col("low") != F.col("high"))
    sizes = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(~F.col("met")).alias("alone"), F.count_if("met").alias("met")
    ).first()
    distinct = sizes["alone"]
    if sizes["met"]:
        met = materialise(groups.where("met").select(F.col("h").alias("_h")), "met")
        distinct += df.join(met, first == F.col("_h"), "left_semi").distinct().count()
    return _dup_row(df, sizes["rows"], distinct)


def _dup_row(df: DataFrame, rows: int, distinct: int) -> DataFrame:
    found = [(rows, len(df.columns), distinct, rows - distinct)]
    return df.sparkSession.createDataFrame(found, "total_rows long, total_columns long, distinct_rows long, duplicate_rows long")


def _family(kind: T.DataType) -> tuple[str, Callable[[Column], Column]]:
    """The type in which columns of a kind are counted together, and how a value gets there; equal values stay equal."""
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return "bigint", lambda c: c.cast("long")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return "double", lambda c: c.cast("double") + 0.0  # both zeros are one value
    if isinstance(kind, T.TimestampType):
        return "bigint", F.unix_micros  # as instants, not as local times, of which an autumn hour would repeat
    if isinstance(kind, T.DateType):
        return "bigint", lambda c: F.unix_date(c).cast("long")
    return kind.simpleString(), lambda c: c


def cardinality_profile(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct values per column, null counted as one value.

    Columns are counted in families of a type, all of a family in one pass: every task leaves out repeats first, and what is
    shuffled is the number of the column and the value as it is, not as text. ``approximate`` uses one small sketch
    per column and shuffles nothing else.
    """
    columns = columns or df.columns
    if approximate:
        return _per_column(
            df,
            columns,
            distinct_values=lambda c: F.approx_count_distinct(c)
            + F.max(F.when(F.col(c).isNull(), 1).otherwise(0)),
        )
    families: dict[str, list[Column]] = {}
    for i, c in enumerate(columns):
        family, typed = _family(df.schema[c].dataType)
        families.setdefault(family, []).append(F.struct(F.lit(i).alias("i"), typed(F.col(c)).alias("value")))
    counts = [
        df.select(F.inline(F.array(*cells))).distinct().groupBy("i").agg(F.count(F.lit(1)).alias("distinct_values"))
        for cells in families.values()
    ]
    name = F.array(*map(F.lit, columns))[F.col("i")].alias("column")
    return reduce(DataFrame.unionAll, counts).select(name, "distinct_values")


def frequency_table(df: DataFrame, columns: Sequence[str], top: int = 30) -> DataFrame:
    """The ``top`` most frequent values of each column, all columns in one pass.

    Values are ranked within 64 parts of a column first, and what each part keeps is ranked again: one task meets
    64 x ``top`` values of a column at most, however many it has.
    """
    order = F.desc("n"), F.asc("value")
    in_part = Window.partitionBy("column", F.pmod(F.xxhash64("value"), F.lit(64))).orderBy(*order)
    kept = value_counts(df, columns).withColumn("position", F.row_number().over(in_part)).where(F.col("position") <= top)
    by_count = Window.partitionBy("column").orderBy(*order)
    return kept.withColumn("position", F.row_number().over(by_count)).where(F.col("position") <= top)


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per class (one row per class)."""
    classes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = classes.agg(F.sum("n").alias("_all"))  # one row
    share = F.round(F.lit(100.0) * F.col("n") / F.col("_all"), 2)
    return classes.crossJoin(F.broadcast(total)).withColumn("share_pct", share).drop("_all")


def describe_profile(df: DataFrame, digits: int = 4) -> DataFrame:
    """Schema and non-null count of all columns, with mean, deviation and range of numbers and the range of others as text.

    Numbers are unpivoted and aggregated per column: one short aggregate instead of
    one per column, which would outgrow the code generator on wide tables.
    """
    fields = {f.name: f for f in df.schema.fields}
    numeric = numeric_columns(df)
    # Arrays and maps have no order that would make a range worth showing.
    others = [c for c in df.columns if c not in numeric]
    ranged = {c for c in others if not isinstance(fields[c].dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))}
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")

    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("number")) for c in numeric]
    numbers = (
        df.select(F.inline(F.array(*cells or [F.struct(no_text.alias("column"), no_number.alias("number"))])))
        .groupBy("column")
        .agg(
            F.count("number").alias("non_null"),
            F.round(F.avg("number"), digits).alias("mean"),
            F.round(F.stddev_samp("number"), digits).alias("stddev"),
            F.round(F.min("number"), digits).alias("min_value"),
            F.round(F.max("number"), digits).alias("max_value"),
        )
        .withColumns({"min_text": no_text, "max_text": no_text})
    )
    figures = [numbers] if numeric else []
    if others:
        figures.append(_range_of_texts(df, others, ranged))
    schema = [(c, fields[c].dataType.simpleString(), fields[c].nullable) for c in [*numeric, *others]]
    names = df.sparkSession.createDataFrame(schema, "column string, data_type string, nullable boolean")
    return names.join(reduce(DataFrame.unionByName, figures), "column") if figures else names


def _range_of_texts(df: DataFrame, columns: Sequence[str], ranged: set[str]) -> DataFrame:
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    return _per_column(
        df,
        columns,
        non_null=F.count,
        mean=lambda c: no_number,
        stddev=lambda c: no_number,
        min_value=lambda c: no_number,
        max_value=lambda c: no_number,
        min_text=lambda c: F.min(c).cast("string") if c in ranged else no_text,
        max_text=lambda c: F.max(c).cast("string") if c in ranged else no_text,
    )


def median_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Exact median (an element of the column) of each numeric column, shown as double.

    :func:`fit_quantiles` itself returns integers and decimals in their own type.
    """
    columns = columns or numeric_columns(df)
    medians = fit_quantiles(df, columns, [0.5])
    rows = [(c, None if v[0] is None else float(v[0])) for c, v in medians.items()]
    return df.sparkSession.createDataFrame(rows, "column string, median double")


def box_stats(df: DataFrame, columns: Sequence[str] | None = None, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers and outlier count per column; fences at ``reach`` times the IQR."""
    columns = columns or numeric_columns(df)
    quartiles = {
        c: [float(v) for v in q]
        for c, q in fit_quantiles(df, columns, [0.25, 0.5, 0.75], interpolate=True).items()
        if q[0] is not None
    }

    def fences(c):
        q1, _, q3 = quartiles[c]
        spread = (q3 - q1) * reach
        return F.lit(q1 - spread), F.lit(q3 + spread)

    def within(c):
        return F.col(c).between(*fences(c))

    if not quartiles:  # no column has a value
        empty = "column string, q1 double, median double, q3 double, whisker_low double, whisker_high double, outliers long"
        return df.sparkSession.createDataFrame([], empty)
    return _per_column(
        df,
        list(quartiles),
        q1=lambda c: F.lit(quartiles[c][0]),
        median=lambda c: F.lit(quartiles[c][1]),
        q3=lambda c: F.lit(quartiles[c][2]),
        whisker_low=lambda c: F.min(F.when(within(c), F.col(c).cast("double"))),
        whisker_high=lambda c: F.max(F.when(within(c), F.col(c).cast("double"))),
        outliers=lambda c: F.count_if(~within(c)),
    )


def corr_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair, below the diagonal; null pairs are skipped.

    Each task reduces its rows, a batch at a time, to the moments of all pairs by matrix products; one row per pair and
    task leaves it. Moments are taken around the task's first mean, and merged around the mean of all.
    """
    columns = list(columns or numeric_columns(df))
    lower = [(i, j) for i in range(len(columns)) for j in range(i)]
    if not lower:
        return df.sparkSession.createDataFrame([], "x string, y string, r double")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = shift = None
        for batch in batches:
            if not batch.num_rows:
                continue
            given = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            mask = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            values = np.where(mask, given, 0.0)
            if shift is None:
                shift = values.sum(axis=0) / np.maximum(mask.sum(axis=0), 1)
            values, mask = np.where(mask, values - shift, 0.0), mask.astype(np.float64)
            # Element (a, b) sums over the rows in which both are known.
            part = np.stack([mask.T @ mask, values.T @ mask, (values * values).T @ mask, values.T @ values])
            total = part if total is None else total + part
        if total is None:
            return
        rows = []
        for p, (i, j) in enumerate(lower):
            n = total[0, i, j]
            if n:
                x, y = total[1, i, j] / n, total[1, j, i] / n
                spread = total[2, i, j] - n * x * x, total[2, j, i] - n * y * y, total[3, i, j] - n * x * y
                rows.append((p, n, x + shift[i], y + shift[j], *spread))
        names = ["p", "n", "mx", "my", "xx", "yy", "xy"]
        kinds = [pa.int32(), *[pa.float64()] * 6]
        arrays = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names)

    cells = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    parts = cells.mapInArrow(moments, "p int, n double, mx double, my double, xx double, yy double, xy double")
    pair = Window.partitionBy("p")  # one row per task
    dx, dy = (F.col(m) - F.sum(F.col(m) * F.col("n")).over(pair) / F.sum("n").over(pair) for m in ("mx", "my"))
    merged = parts.withColumns({"dx": dx, "dy": dy}).groupBy("p").agg(
        F.sum(F.col("xx") + F.col("n") * F.col("dx") * F.col("dx")).alias("xx"),
        F.sum(F.col("yy") + F.col("n") * F.col("dy") * F.col("dy")).alias("yy"),
        F.sum(F.col("xy") + F.col("n") * F.col("dx") * F.col("dy")).alias("xy"),
    )
    names = [F.array(*[F.lit(columns[q[side]]) for q in lower])[F.col("p")] for side in (0, 1)]
    size = F.sqrt(F.greatest("xx", F.lit(0.0))) * F.sqrt(F.greatest("yy", F.lit(0.0)))
    r = F.col("xy") / F.nullif(size, F.lit(0.0))
    return merged.select(names[0].alias("x"), names[1].alias("y"), r.alias("r"))


def mutual_info(df: DataFrame, features: Sequence[str], label: Column, bins: int = 10) -> DataFrame:
    """Mutual information (nats) of each feature, cut at its quantiles, with the label.

    Rows with a null feature or label do not count for that feature. Only the counts
    per (feature, bin, label) leave the scan.
    """
    cuts = fit_quantiles(df, features, [i / bins for i in range(1, bins)])
    known = [c for c in features if cuts[c][0] is not None]

    # Unpivot first and bin after: one short expression for all features.
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v")) for i, c in enumerate(known)])
    cut = [F.array(*[F.lit(cuts[c][j]) for c in known])[F.col("i")] for j in range(bins - 1)]
    bin_of = reduce(lambda a, b: a + b, [F.when(F.col("v") > c, 1).otherwise(0) for c in cut])
    joint = (
        df.select(label.cast("string").alias("label"), cells.alias("cells"))
        .where(F.col("label").isNotNull())
        .select("label", F.inline("cells"))
        .where(F.col("v").isNotNull())
        .groupBy(F.array(*map(F.lit, known))[F.col("i")].alias("feature"), bin_of.alias("bin"), "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # At most features x bins x classes rows from here on.
    total = F.sum("n").over(Window.partitionBy("feature"))
    in_bin = F.sum("n").over(Window.partitionBy("feature", "bin"))
    in_label = F.sum("n").over(Window.partitionBy("feature", "label"))
    term = F.col("n") / total * F.log(F.col("n") * total.cast("double") / (in_bin * in_label))
    return joint.select("feature", term.alias("term")).groupBy("feature").agg(F.sum("term").alias("mi"))


def select_features(
    df: DataFrame, features: Sequence[str], label: Column, max_abs_corr: float = 0.8, bins: int = 10
) -> DataFrame:
    """Of every highly correlated pair, drop the feature that tells less about the label."""
    mi = materialise(mutual_info(df, features, label, bins), "mi")  # one row per feature, used three times
    strong = corr_matrix(df, features).where(F.abs("r") >= max_abs_corr)
    mx = mi.select(F.col("feature").alias("x"), F.col("mi").alias("mi_x"))
    my = mi.select(F.col("feature").alias("y"), F.col("mi").alias("mi_y"))
    weaker = F.when((F.col("mi_x") < F.col("mi_y")) | ((F.col("mi_x") == F.col("mi_y")) & (F.col("x") > F.col("y"))), F.col("x"))
    dropped = (
        strong.join(mx, "x").join(my, "y").select(weaker.otherwise(F.col("y")).alias("feature")).distinct()
    )
    return mi.join(dropped.withColumn("_drop", F.lit(True)), "feature", "left").select(
        "feature", "mi", F.col("_drop").isNull().alias("kept")
    )


def monthly_means(df: DataFrame, at: str, measures: Sequence[str], digits: int = 4) -> DataFrame:
    """Mean of each measure per calendar month."""
    means = [F.round(F.avg(m), digits).alias(f"avg_{m}") for m in measures]
    return df.groupBy(F.month(at).alias("month")).agg(*means).orderBy("month")


def top_entities(df: DataFrame, entity: str, measure: str, top: int | None = 10, digits: int = 4) -> DataFrame:
    """Entities by their mean of a measure, highest first."""
    mean = F.col("_mean")
    ranked = df.groupBy(entity).agg(F.avg(measure).alias("_mean")).orderBy(mean.desc(), F.col(entity))
    ranked = ranked.limit(top) if top else ranked
    return ranked.select(entity, F.round(mean, digits).alias(f"avg_{measure}"))
