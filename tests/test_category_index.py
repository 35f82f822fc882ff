"""The table-backed category index, alone and inside a saved feature model, and counts of skipped rows."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from helpers import rows
from tidewheel.operators import category_index, features
from tidewheel.operators.category_index import CategoryIndex, fit_category_index


@pytest.fixture(scope="module")
def keyed(spark):
    """A third of the rows share one value; many values occur once; some rows have none."""
    i = F.col("id")
    value = F.when(i % 3 == 0, "hot").when(i % 7 == 0, None).otherwise(F.concat(F.lit("v"), (i % 400).cast("string")))
    return spark.range(3000).select(i, value.alias("key"), (i % 50).cast("double").alias("x"), (i % 5).cast("string").alias("kind")).cache()


def test_numbers_equal_those_of_a_string_indexer(spark, keyed, tmp_path):
    fit_category_index(keyed, "key", frequent_values=10).save(str(tmp_path / "index"))
    index = CategoryIndex.load(spark, "key", str(tmp_path / "index"))
    assert rows(index.table.where("frequent"), "value") == [("hot",)]
    got = index.transform(keyed, "key_index")
    assert got.columns == [*keyed.columns, "key_index"] and got.count() == 3000
    want = features.string_index(keyed.where("key IS NOT NULL"), ["key"])
    assert rows(got.where("key IS NOT NULL"), "id", "key_index") == rows(want, "id", "key_index")
    assert got.where("key IS NULL AND key_index IS NULL").count() == keyed.where("key IS NULL").count()


def test_unseen_values_and_empty_training(spark, keyed):
    index = fit_category_index(keyed.where("key = 'hot' OR key = 'v1'"), "key")
    got = index.transform(keyed, "i")
    assert rows(got.where("i IS NOT NULL").select("key", "i").distinct()) == [("hot", 0.0), ("v1", 1.0)]
    nothing = fit_category_index(keyed.where("FALSE"), "key").transform(keyed, "i")
    assert nothing.count() == 3000 and nothing.where("i IS NOT NULL").count() == 0


def test_rows_of_a_frequent_value_are_spread_over_the_join(spark, keyed):
    index = fit_category_index(keyed, "key", frequent_values=10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = index.transform(keyed, "i")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1
    assert max(sizes) < 2 * 3000 / len(sizes)  # without the salt one partition would hold the third that is hot


def test_a_saved_model_holds_the_table(spark, keyed, tmp_path):
    train = keyed.where("id % 4 <> 0")
    model = features.fit_features(train, ["x"], ["kind"], "onehot", large=["key"])
    model.save(spark, str(tmp_path / "m"))
    loaded = features.FeatureModel.load(spark, str(tmp_path / "m"))
    assert [t.column for t in loaded.tables] == ["key"]
    assert not any("key" in str(s.labelsArray) for s in loaded.stages.stages if hasattr(s, "labelsArray"))
    v = vector_to_array("scaled_features").alias("v")
    got = rows(loaded.transform(keyed).select("id", v))
    assert got == rows(model.transform(keyed).select("id", v))
    seen = {r[0] for r in train.select("key").distinct().collect()} - {None}
    assert len(got) == keyed.where(F.col("key").isin(list(seen))).count() > 2000
    # Models without tables load too, also those saved before there were any.
    plain = features.fit_features(train, ["x"], ["kind"])
    plain.save(spark, str(tmp_path / "plain"))
    assert features.FeatureModel.load(spark, str(tmp_path / "plain")).tables == []


def test_skipped_rows_are_counted_by_cause_on_the_scoring_pass(spark, keyed, tmp_path):
    train = keyed.where("kind <> '4' AND key <> 'hot'")
    model = features.fit_features(train, ["x"], ["kind"], fills=features.FillValues(), large=["key"])
    given = keyed.withColumn("x", F.expr("CASE WHEN id % 11 = 0 THEN NULL WHEN id % 11 = 1 THEN double('nan') ELSE x END"))
    given = given.withColumn("kind", F.expr("CASE WHEN id % 13 <> 0 THEN kind END"))
    model.transform_marked(given).write.parquet(str(tmp_path / "out"))
    marked = spark.read.parquet(str(tmp_path / "out"))
    found = {r["cause"]: r["n"] for r in model.skip_counts(marked).collect()}
    n = lambda condition: given.where(condition).count()
    bad_x = "x IS NULL OR isnan(x)"
    known = [r[0] for r in train.select("key").distinct().collect()]
    assert found == {
        "given": 3000,
        "kept": n(f"kind <> '4' AND key <> 'hot' AND NOT ({bad_x})"),
        "unseen key": n(F.col("key").isNotNull() & ~F.col("key").isin(known)),
        "missing key": n("key IS NULL"),
        "unseen kind": n("kind = '4'"),
        "missing kind": n("kind IS NULL"),
        "missing x": n(bad_x),
    }
    v = vector_to_array("scaled_features").alias("v")
    assert rows(marked.where("size(skipped) = 0"), "id", v) == rows(model.transform(given), "id", v)
    assert marked.where("size(skipped) > 0 AND scaled_features IS NOT NULL").count() == 0
    assert marked.count() == 3000 and rows(marked, "id", "kind") == rows(given, "id", "kind")  # columns stay as given
    assert category_index.FREQUENT_VALUES <= 10_000  # what is broadcast stays small


def test_a_stream_uses_the_same_table(spark, keyed, tmp_path):
    index = fit_category_index(keyed, "key")
    keyed.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(keyed.schema).parquet(str(tmp_path / "in"))
    query = index.transform(stream, "i").writeStream.format("parquet").option("path", str(tmp_path / "out"))
    query.option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "id", "i") == rows(index.transform(keyed, "i"), "id", "i")
