"""Classifier metrics as aggregates: nothing but counts leaves the executors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import running_totals


def positive_probability(column: str = "probability") -> Column:
    """Probability of class 1 from the model's vector."""
    return vector_to_array(F.col(column))[1]


def weighted_f1(df: DataFrame, label: Column, prediction: Column) -> DataFrame:
    """F1 averaged over the classes, weighted by how often each is true. Rows without a label do not count."""
    labelled = df.where(label.isNotNull())
    cells = labelled.groupBy(label.cast("double").alias("label"), prediction.cast("double").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )
    per_class = _class_counts(cells, [])
    f1 = F.lit(2.0) * F.col("tp") / (F.col("actual") + F.col("predicted"))
    return per_class.agg((F.sum(F.col("actual") * f1) / F.sum("actual")).alias("weighted_f1"), F.sum("actual").alias("n"))


def _class_counts(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per class how many rows have it, how many are predicted to, and both, from counts by label and prediction."""
    # Unpivot each cell into the class it belongs to as truth and as prediction.
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("actual"), zero.alias("predicted"), hit.alias("tp")),
        F.struct(F.col("prediction").alias("class"), zero.alias("actual"), F.col("n").alias("predicted"), zero.alias("tp")),
    )
    return (
        cells.select(*keys, F.inline(sides))
        .groupBy(*keys, "class")
        .agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "tp")])
    )


def score_counts(df: DataFrame, label: Column, score: Column) -> DataFrame:
    """Positives and negatives per distinct score."""
    positive = label.cast("double") == 1.0
    return df.groupBy(score.alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )


def _roc_steps(df: DataFrame, label: Column, score: Column, slices: int | None) -> DataFrame:
    """Score counts with true and false positives down to each score and the grand totals."""
    return running_totals(
        score_counts(df, label, score),
        [F.col("score").desc()],
        sums={"tp": "pos", "fp": "neg"},
        totals={"all_pos": "pos", "all_neg": "neg"},
        following={"next_pos": "pos", "next_neg": "neg"},
        slices=slices,
    )


def roc_curve(df: DataFrame, label: Column, score: Column, slices: int | None = None) -> DataFrame:
    """One point per distinct score, from the highest down, after the start (0, 0).

    ``corner`` marks the points a plotted curve needs: its ends and every point where
    the step to the next score differs from the step before.
    """
    steps = _roc_steps(df, label, score, slices)
    first = F.col("tp") + F.col("fp") == F.col("pos") + F.col("neg")
    turn = F.col("next_pos").isNull() | (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    points = steps.select(
        "score",
        (F.col("fp") / F.nullif(F.col("all_neg"), F.lit(0))).alias("fpr"),
        (F.col("tp") / F.nullif(F.col("all_pos"), F.lit(0))).alias("tpr"),
        (first | turn).alias("corner"),
    )
    start = df.sparkSession.createDataFrame([(None, 0.0, 0.0, True)], points.schema)
    return start.unionByName(points)


def auc_score(df: DataFrame, label: Column, score: Column, slices: int | None = None) -> DataFrame:
    """Exact area under the ROC curve by the trapezoid rule over all distinct scores."""
    steps = _roc_steps(df, label, score, slices)
    area = F.col("neg").cast("double") * (2 * F.col("tp") - F.col("pos")) / 2
    return steps.agg(
        (F.sum(area) / F.nullif(F.max("all_pos").cast("double") * F.max("all_neg"), F.lit(0.0))).alias("auc"),
        F.max("all_pos").alias("positives"),
        F.max("all_neg").alias("negatives"),
    )


def outcome_counts(
    df: DataFrame, keys: Sequence[str], label: Column, prediction: Column, score: Column
) -> DataFrame:
    """Rows per group, label, prediction and score: all that the metrics of scored rows need, from one pass over them.

    Rows without a label do not count. ``keys`` must not be named label, prediction, score or n.
    """
    cells = [label.cast("double").alias("label"), prediction.cast("double").alias("prediction"), score.alias("score")]
    return df.where(label.isNotNull()).groupBy(*keys, *cells).agg(F.count(F.lit(1)).alias("n"))


def auc_by(counts: DataFrame, keys: Sequence[str], slices: int | None = None) -> DataFrame:
    """:func:`auc_score` of every group of :func:`outcome_counts`, by one running count over all groups.

    A group's own true positives are the running count less what came before the group, so many groups and groups of any
    size share one range-partitioned pass. ``auc`` is null where one class is missing.
    """
    positive = F.col("label") == 1.0
    per_score = counts.groupBy(*keys, "score").agg(
        F.sum(F.when(positive, F.col("n")).otherwise(0)).alias("pos"),
        F.sum(F.when(positive, 0).otherwise(F.col("n"))).alias("neg"),
    )
    steps = running_totals(per_score, [*keys, F.col("score").desc()], {"tp": "pos"}, slices=slices)
    pairs = F.col("neg").cast("double") * (2 * F.col("tp") - F.col("pos")) / 2
    sums = steps.groupBy(*keys).agg(
        F.sum(pairs).alias("_pairs"),
        F.min(F.col("tp") - F.col("pos")).alias("_before"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    )
    every = F.col("positives").cast("double") * F.col("negatives")
    area = F.col("_pairs") - F.col("_before").cast("double") * F.col("negatives")
    return sums.select(*keys, (area / F.nullif(every, F.lit(0.0))).alias("auc"), "positives", "negatives")


def weighted_f1_by(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """:func:`weighted_f1` of every group of :func:`outcome_counts`."""
    cells = counts.groupBy(*keys, "label", "prediction").agg(F.sum("n").alias("n"))
    per_class = _class_counts(cells, keys)
    f1 = F.lit(2.0) * F.col("tp") / (F.col("actual") + F.col("predicted"))
    return per_class.groupBy(*keys).agg(
        (F.sum(F.col("actual") * f1) / F.sum("actual")).alias("weighted_f1"), F.sum("actual").alias("n")
    )


def pivot_metric(
    df: DataFrame, row: str, column: str, values: Sequence[str], metric: str, digits: int | None = None
) -> DataFrame:
    """One row per ``row`` value, one column per listed ``column`` value."""
    value = F.first(metric, ignorenulls=True)
    return df.groupBy(row).pivot(column, list(values)).agg(value if digits is None else F.round(value, digits))


def best_model(results: DataFrame, by: Sequence[str], tie_break: Sequence[str] = ()) -> DataFrame:
    """The row with the highest metrics, compared in the given order."""
    return results.orderBy(*[F.desc(c) for c in by], *tie_break).limit(1)
