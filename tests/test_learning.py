import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from helpers import by, rows
from tidewheel.operators import evaluate, features, models, split

NUMERIC = ["x", "y"]
CATEGORICAL = ["kind"]


@pytest.fixture(scope="module")
def points(spark):
    i = F.col("id")
    return spark.range(400).select(
        i,
        (i % 17).cast("double").alias("x"),
        F.when(i % 10 != 0, i * 7 % 23).cast("double").alias("y"),
        F.when(i % 3 == 0, "a").when(i % 3 == 1, "b").when(i % 11 != 0, "c").alias("kind"),
        ((i % 17 > 8) & (i * 31 % 10 < 8)).cast("double").alias("label"),
    ).cache()


def test_split_is_disjoint_complete_and_independent_of_partitioning(points):
    train, test = split.hash_split(points, ["id"])
    again, _ = split.hash_split(points.repartition(7), ["id"])
    assert train.count() + test.count() == 400
    assert train.join(test, "id").count() == 0
    assert rows(train, "id") == rows(again, "id")
    assert 240 < train.count() < 320
    other, _ = split.hash_split(points, ["id"], seed=43)
    assert rows(other, "id") != rows(train, "id")


def test_index_ties_go_by_name(spark):
    df = spark.createDataFrame([(c,) for c in "bacc"], "k string")
    got = features.string_index(df, ["k"]).distinct()
    assert rows(got) == [("a", 1.0), ("b", 2.0), ("c", 0.0)]


def test_frequency_index_equals_string_index(points):
    expected = features.string_index(points.where("kind IS NOT NULL"), ["kind"])
    assert rows(features.frequency_index(points, "kind"), "id", "kind_index") == rows(expected, "id", "kind_index")


def test_one_hot_drops_the_last_category(spark):
    df = spark.createDataFrame([(c,) for c in "bacc"], "k string")
    got = features.one_hot(df, ["k"]).select("k", vector_to_array("k_ohe").alias("v")).distinct()
    assert {r["k"]: r["v"] for r in got.collect()} == {"c": [1.0, 0.0], "a": [0.0, 1.0], "b": [0.0, 0.0]}


def test_scaling_divides_by_the_sample_deviation(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    got = features.assemble_scale(df, ["x"]).select(vector_to_array("scaled_features")[0])
    assert rows(got) == [(1.0,), (2.0,), (3.0,)]


def test_features_are_fitted_on_train_only_and_survive_saving(spark, points, tmp_path):
    train, test = split.hash_split(points, ["id"])
    fitted = features.fit_features(train, NUMERIC, CATEGORICAL)
    doubled = features.fit_features(train.unionByName(test.limit(0)), NUMERIC, CATEGORICAL)
    assert fitted.fills == doubled.fills
    fitted.save(spark, f"{tmp_path}/f")
    loaded = features.FeatureModel.load(spark, f"{tmp_path}/f")
    assert rows(loaded.transform(test), "id", "scaled_features") == rows(fitted.transform(test), "id", "scaled_features")


def test_nulls_are_imputed_and_unseen_categories_skipped(spark, points):
    fitted = features.fit_features(points, NUMERIC, CATEGORICAL)
    new = spark.createDataFrame([(1, 1.0, None, None), (2, None, 2.0, "a"), (3, 1.0, 1.0, "zzz")], "id int, x double, y double, kind string")
    assert rows(fitted.transform(new), "id") == [(1,), (2,)]


@pytest.fixture(scope="module")
def scored(points):
    encoded = features.fit_features(points, NUMERIC, CATEGORICAL).transform(points)
    return LogisticRegression(featuresCol="scaled_features").fit(encoded).transform(encoded).cache()


def test_auc_and_f1_equal_the_evaluators(scored):
    label, score = F.col("label"), evaluate.positive_probability()
    exact = BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0).evaluate(scored)
    assert evaluate.auc_score(scored, label, score, slices=5).first()["auc"] == pytest.approx(exact, abs=1e-12)
    f1 = MulticlassClassificationEvaluator(metricName="f1").evaluate(scored)
    assert evaluate.weighted_f1(scored, label, F.col("prediction")).first()["weighted_f1"] == pytest.approx(f1, abs=1e-12)


def _trapezoid(points):
    points = sorted(points)
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))


def test_roc_corners_describe_the_same_curve(scored):
    curve = evaluate.roc_curve(scored, F.col("label"), evaluate.positive_probability(), slices=5)
    every = [(r["fpr"], r["tpr"]) for r in curve.collect()]
    corners = [(r["fpr"], r["tpr"]) for r in curve.where("corner").collect()]
    assert (0.0, 0.0) in corners and (1.0, 1.0) in corners and len(corners) < len(every)
    assert _trapezoid(corners) == pytest.approx(_trapezoid(every), abs=1e-12)


def test_metrics_of_groups_equal_those_of_each_group(points):
    grouped = points.withColumn("part", F.when(F.col("id") < 30, "few").when(F.col("id") < 35, None).otherwise("rest"))
    grouped = grouped.withColumn("label", F.when(F.col("id") % 9 > 0, F.col("label")))
    label, prediction, score = F.col("label"), (F.col("x") > 7).cast("double"), F.col("x")
    counts = evaluate.outcome_counts(grouped, ["part"], label, prediction, score)
    auc, f1 = by(evaluate.auc_by(counts, ["part"], slices=5), "part"), by(evaluate.weighted_f1_by(counts, ["part"]), "part")
    for part in ("few", None, "rest"):
        own = grouped.where(F.col("part").eqNullSafe(F.lit(part)) & label.isNotNull())
        assert tuple(auc[part])[1:] == pytest.approx(tuple(evaluate.auc_score(own, label, score).first()), abs=1e-12)
        assert tuple(f1[part])[1:] == pytest.approx(tuple(evaluate.weighted_f1(own, label, prediction).first()), abs=1e-12)


def test_auc_without_one_class_is_null(points):
    assert evaluate.auc_score(points, F.lit(1.0), F.col("x")).first()["auc"] is None


def test_pivot_and_best(spark):
    results = spark.createDataFrame(
        [("index", "LR", 0.8, 0.7), ("onehot", "LR", 0.9, 0.6), ("index", "DT", 0.9, 0.7)],
        "encoding string, model string, roc_auc double, f1 double",
    )
    pivot = by(evaluate.pivot_metric(results, "model", "encoding", ["index", "onehot"], "roc_auc"), "model")
    assert tuple(pivot["LR"]) == ("LR", 0.8, 0.9) and tuple(pivot["DT"]) == ("DT", 0.9, None)
    assert evaluate.best_model(results, ["roc_auc", "f1"]).first()["model"] == "DT"


def test_compare_saves_the_selected_model(spark, points, tmp_path):
    train, test = split.hash_split(points, ["id"])
    chosen = {n: m for n, m in models.classifiers().items() if n != "Random Forest"}
    comparison = models.model_compare(train, test, NUMERIC, CATEGORICAL, "label", models=chosen)
    table = comparison.results.collect()
    assert {(r["encoding"], r["model"]) for r in table} == {(e, m) for e in ("index", "onehot") for m in chosen}
    assert all(r["fit_seconds"] > 0 and r["time_seconds"] >= r["score_seconds"] > 0 for r in table)
    for r in table:  # one model by itself gives what all together gave
        alone = models.score(comparison.models[r["encoding"], r["model"]], comparison.features[r["encoding"]], test)
        exact = BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0).evaluate(alone)
        f1 = MulticlassClassificationEvaluator(metricName="f1").evaluate(alone)
        assert (r["roc_auc"], r["f1_score"]) == (pytest.approx(exact, abs=1e-12), pytest.approx(f1, abs=1e-12))
    best = max(table, key=lambda r: (r["roc_auc"], r["f1_score"]))
    _, model = comparison.best()
    assert type(model).__name__.startswith(best["model"].replace(" ", "").removesuffix("Regression"))
    comparison.save_best(spark, f"{tmp_path}/best")
    loaded = features.FeatureModel.load(spark, f"{tmp_path}/best/features")
    saved = type(model).load(f"{tmp_path}/best/model")
    assert models.score(saved, loaded, test).count() == test.count()
