"""Parameterised analytic reports. Each names its key, condition and value columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import band, conditional_percent, match_count, percent_where, tag
from .ordered import MAX_GROUP_ROWS, run_spans, with_neighbours, with_ntile, with_rank


def period_vs_mean(
    df: DataFrame,
    period: Mapping[str, Column],
    condition: Column,
    measure: Column,
    high: float = 1.15,
    low: float = 0.85,
    labels: tuple[str, str, str] = ("above", "below", "normal"),
) -> DataFrame:
    """Each period's mean against the mean of all periods' (rounded) means."""
    by_period = df.groupBy(*[e.alias(n) for n, e in period.items()]).agg(
        F.count(F.lit(1)).alias("n"),
        match_count(condition).alias("hits"),
        percent_where(condition).alias("hit_pct"),
        F.round(F.avg(measure), 2).alias("mean_value"),
    )
    overall = by_period.agg(F.avg("mean_value").alias("_overall"))  # one row
    verdict = (
        F.when(F.col("mean_value") > F.col("_overall") * high, labels[0])
        .when(F.col("mean_value") < F.col("_overall") * low, labels[1])
        .otherwise(labels[2])
    )
    return (
        by_period.crossJoin(F.broadcast(overall))
        .withColumns(
            {
                "overall_mean": F.round("_overall", 2),
                "deviation": F.round(F.col("mean_value") - F.col("_overall"), 2),
                "verdict": verdict,
            }
        )
        .drop("_overall")
        .orderBy(*period)
    )


def rank_in_group(
    df: DataFrame,
    group: str,
    category: str,
    condition: Column,
    means: Mapping[str, tuple[Column, int]],
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Categories ranked inside their group by the unrounded share of matching rows."""
    table = df.groupBy(group, category).agg(
        F.count(F.lit(1)).alias("n"),
        match_count(condition).alias("hits"),
        percent_where(condition).alias("hit_pct"),
        percent_where(condition, None).alias("_exact"),
        *_means(means),
    )
    ranked = with_rank(table, [group], "_exact", "rank_in_group", max_group_rows=max_group_rows)
    return ranked.drop("_exact").orderBy(group, F.desc("hit_pct"), category)


def lag_delta_buckets(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    condition: Column,
    limits: Sequence[tuple[str, float]],
    labels: Sequence[str],
    outcome: tuple[str, str] | None = None,
    max_gap_days: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Share of matching rows by how far the value fell since the previous row of its key.

    ``outcome`` = (new column, source) adds the following row's value for the
    condition. ``max_gap_days`` keeps only pairs at most that many days apart.
    """
    previous = {"_value_before": value, "_at_before": order[0]}
    following = {outcome[0]: outcome[1]} if outcome else {}
    rows = with_neighbours(df, keys, order, previous, following, max_group_rows)
    if outcome:
        rows = rows.where(F.col(outcome[0]).isNotNull())
    if max_gap_days is not None:
        rows = rows.where(F.date_diff(F.col(order[0]), F.col("_at_before")) <= max_gap_days)
    fall = F.col("_value_before") - F.col(value)
    return (
        rows.withColumn("_fall", fall)
        .where(F.col("_fall").isNotNull())
        .groupBy(band(F.col("_fall"), limits, labels).alias("change_band"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            match_count(condition).alias("hits"),
            percent_where(condition).alias("hit_pct"),
        )
        .orderBy(F.desc("change_band"))
    )


def conditional_rate(
    df: DataFrame,
    by: Sequence[str],
    condition: Column,
    min_rows: int = 1,
    means: Mapping[str, tuple[Column, int]] | None = None,
) -> DataFrame:
    """Share of matching rows per group, for groups of at least ``min_rows``."""
    return (
        df.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            match_count(condition).alias("hits"),
            percent_where(condition).alias("hit_pct"),
            *_means(means or {}),
        )
        .where(F.col("n") >= min_rows)
        .orderBy(*by[:-1], F.desc("hit_pct"), *by[-1:])
    )


def decile_rate(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    tie_break: Sequence[str],
    condition: Column,
    buckets: int = 10,
    alert_pct: float = 50.0,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Share of matching rows per value decile of each key, flagged from ``alert_pct`` on."""
    exact = percent_where(condition, None)
    return (
        with_ntile(df, keys, [value, *tie_break], buckets, "bucket", max_group_rows)
        .groupBy(*keys, "bucket")
        .agg(
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
            F.count(F.lit(1)).alias("n"),
            percent_where(condition).alias("hit_pct"),
            F.when(exact >= alert_pct, "alert").otherwise("").alias("alert"),
        )
        .orderBy(*keys, "bucket")
    )


def bucket_matrix(df: DataFrame, bands: Mapping[str, Column], condition: Column, min_rows: int = 1) -> DataFrame:
    """Share of matching rows per combination of bands, for cells of at least ``min_rows``."""
    return (
        df.groupBy(*[e.alias(n) for n, e in bands.items()])
        .agg(
            F.count(F.lit(1)).alias("n"),
            match_count(condition).alias("hits"),
            percent_where(condition).alias("hit_pct"),
        )
        .where(F.col("n") >= min_rows)
        .orderBy(F.desc("hit_pct"), *bands)
    )


def ytd_running_sum(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    amount: str,
    year_tags: Mapping[int, str],
    digits: int = 1,
    scale: int = 10,
) -> DataFrame:
    """Daily amounts and their running total since January 1st.

    Rows are first added up per day, so a window never holds more than 366 rows.
    Sums are decimal with ``scale`` digits, which makes them independent of row order, and are rounded once at the end.
    """
    daily = df.groupBy(*keys, F.to_date(date).alias("full_date")).agg(
        F.sum(F.col(amount).cast(f"decimal(28,{scale})")).alias("_amount")
    )
    year = F.year("full_date")
    to_date = (
        Window.partitionBy(*keys, "year").orderBy("full_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        daily.withColumn("year", year)
        .select(
            *keys,
            "year",
            "full_date",
            F.month("full_date").alias("month"),
            F.dayofyear("full_date").alias("day_of_year"),
            F.round("_amount", digits).cast("double").alias("day_amount"),
            F.round(F.sum("_amount").over(to_date), digits).cast("double").alias("ytd_amount"),
            tag(F.col("year"), year_tags).alias("year_tag"),
        )
        .orderBy(*keys, "year", "full_date")
    )


def longest_runs(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    condition: Column,
    min_length: int = 1,
    top: int = 15,
    calendar: bool = False,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """The ``top`` longest unbroken runs of matching rows, dense-ranked by length."""
    spans = run_spans(df, keys, order, condition, calendar, max_group_rows)
    kept = spans.where(F.col("state") & (F.col("run_rows") >= min_length)).drop("state")
    best = kept.orderBy(F.desc("run_rows"), *keys, "run_start").limit(top)
    # The ranks of the first rows depend on those rows alone.
    return best.withColumn("length_rank", F.dense_rank().over(Window.orderBy(F.desc("run_rows")))).orderBy(
        F.desc("run_rows"), *keys, "run_start"
    )


def persistence_rate(df: DataFrame, by: Sequence[str], now: Column, after: Column, min_rows: int = 1) -> DataFrame:
    """How often the condition holds next time, given that it holds now."""
    return (
        df.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            match_count(now).alias("now_hits"),
            match_count(now & after).alias("both_hits"),
            conditional_percent(after, now).alias("persistence_pct"),
        )
        .where(F.col("n") >= min_rows)
        .orderBy(*by[:-1], F.desc("persistence_pct"), *by[-1:])
    )


def league_table(
    df: DataFrame,
    by: str,
    means: Mapping[str, tuple[Column, int]],
    sums: Mapping[str, tuple[Column, int]],
    condition: Column,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Means, sums and share of matching rows per entity, ranked over all entities."""
    table = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"),
        *_means(means),
        *[F.round(F.sum(e), d).cast("double").alias(n) for n, (e, d) in sums.items()],
        percent_where(condition).alias("hit_pct"),
        percent_where(condition, None).alias("_exact"),
    )
    ranked = with_rank(table, [], "_exact", "overall_rank", max_group_rows=max_group_rows)
    return ranked.drop("_exact").orderBy(F.desc("hit_pct"), by)


def _means(means: Mapping[str, tuple[Column, int]]) -> list[Column]:
    return [F.round(F.avg(e), d).alias(n) for n, (e, d) in means.items()]
