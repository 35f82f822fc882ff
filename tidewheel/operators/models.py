"""Training and comparing classifiers."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import materialise
from .evaluate import auc_by, best_model, outcome_counts, positive_probability, weighted_f1_by
from .features import FeatureModel, fit_features

RESULT_SCHEMA = (
    "encoding string, model string, roc_auc double, f1_score double, time_seconds double, fit_seconds double, "
    "score_seconds double"
)


def classifiers(label: str = "label", features: str = "scaled_features", seed: int = 42) -> dict[str, Estimator]:
    """The three models that are compared, with their fixed settings."""
    common = {"labelCol": label, "featuresCol": features}
    return {
        "Logistic Regression": LogisticRegression(**common),
        "Decision Tree": DecisionTreeClassifier(maxDepth=7, seed=seed, **common),
        "Random Forest": RandomForestClassifier(numTrees=50, maxDepth=5, seed=seed, **common),
    }


def score(model: Model, features: FeatureModel, df: DataFrame) -> DataFrame:
    """Predictions for raw rows: imputation, encoding, model."""
    return model.transform(features.transform(df))


def score_all(
    features: Mapping[str, FeatureModel], models: Mapping[tuple[str, str], Model], df: DataFrame, label: str
) -> DataFrame:
    """Scores of raw rows by many models: ``encoding``, ``model``, ``label``, ``prediction`` and ``score``, a row per pair.

    Rows are encoded once per encoding; its models run side by side in that projection, each under columns of its own.
    """
    per_encoding = []
    for encoding, encoder in features.items():
        wide = encoder.transform(df).select("scaled_features", F.col(label).alias("label"))
        parts = []
        for i, (name, model) in enumerate((n, m) for (e, n), m in models.items() if e == encoding):
            outputs = {p: f"_{p}_{i}" for p in ("predictionCol", "probabilityCol", "rawPredictionCol") if model.hasParam(p)}
            wide = model.transform(wide, {model.getParam(p): column for p, column in outputs.items()})
            found = F.col(outputs["predictionCol"]).alias("prediction")
            parts.append(F.struct(F.lit(name).alias("model"), found, positive_probability(outputs["probabilityCol"]).alias("score")))
        if parts:
            per_encoding.append(wide.select(F.lit(encoding).alias("encoding"), "label", F.inline(F.array(*parts))))
    return reduce(lambda a, b: a.unionByName(b), per_encoding)


@dataclass
class Comparison:
    """The results table, everything fitted on the way and the stored scores of the test rows (:func:`score_all`)."""

    results: DataFrame
    features: dict[str, FeatureModel]
    models: dict[tuple[str, str], Model]
    scores: DataFrame

    def best(self) -> tuple[FeatureModel, Model]:
        """Feature and classifier model of the best row of the finished table."""
        row = best_model(self.results, ["roc_auc", "f1_score"], ["encoding", "model"]).first()
        return self.features[row["encoding"]], self.models[row["encoding"], row["model"]]

    def save_best(self, spark: SparkSession, path: str) -> None:
        features, model = self.best()
        features.save(spark, f"{path}/features")
        model.write().overwrite().save(f"{path}/model")


def model_compare(
    train: DataFrame,
    test: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    label: str,
    encodings: Sequence[str] = ("index", "onehot"),
    models: Mapping[str, Estimator] | None = None,
) -> Comparison:
    """Fit every model under every encoding; everything is fitted on ``train`` alone.

    ``label`` is a 0/1 double. One table row per pair: exact ROC AUC, weighted F1 and seconds. All models
    are scored in one pass over the test rows and evaluated together: ``score_seconds`` is an equal share of
    that pass, ``time_seconds`` adds the model's own ``fit_seconds``.
    """
    spark = train.sparkSession
    models = dict(models or classifiers(label))
    fitted_features, fitted_models, fit_seconds, fills = {}, {}, {}, None
    for encoding in encodings:
        features = fitted_features[encoding] = fit_features(train, numeric, categorical, encoding, fills)
        fills = features.fills  # the same for every encoding
        train_set = features.transform(train).select("scaled_features", label).persist(StorageLevel.MEMORY_AND_DISK)
        for name, estimator in models.items():
            started = time.perf_counter()
            fitted_models[encoding, name] = estimator.fit(train_set)
            fit_seconds[encoding, name] = time.perf_counter() - started
        train_set.unpersist()
    started = time.perf_counter()
    scores = materialise(score_all(fitted_features, fitted_models, test, label), "scores")
    keys = ["encoding", "model"]
    counts = materialise(outcome_counts(scores, keys, F.col("label"), F.col("prediction"), F.col("score")), "outcomes")
    measured = auc_by(counts, keys).join(weighted_f1_by(counts, keys), keys)
    found = {(r["encoding"], r["model"]): r for r in measured.collect()}  # one row per model
    share = (time.perf_counter() - started) / len(fitted_models)
    rows = []
    for pair, seconds in fit_seconds.items():
        metrics = (found[pair]["auc"], found[pair]["weighted_f1"]) if pair in found else (None, None)  # no labelled test row
        rows.append((*pair, *metrics, round(seconds + share, 2), round(seconds, 2), round(share, 2)))
    return Comparison(spark.createDataFrame(rows, RESULT_SCHEMA), fitted_features, fitted_models, scores)
