import json

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from helpers import rows
from tidewheel.operators.features import fit_features
from tidewheel.plans import learning
from tidewheel.plans.cleaning import EVENT_SCHEMA
from tidewheel.sources import text_messages
from tidewheel.streaming import Scorer, batch_counts, cdc_unwrap, jdbc_sink, parquet_sink, read_scored

ROW = {"event_id": 1, "event_date": "2024-01-02", "user_id": 7, "event_type": "view", "value": 1.5}


def _unwrap(spark, *messages):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(messages)], "i int, value string")
    out = cdc_unwrap(df.orderBy("i"), EVENT_SCHEMA)
    return [(r["change"], r["event_id"], r["value"]) for r in out.collect()]


def test_all_envelopes(spark):
    wrapped = [{"payload": {"after": ROW}}, {"payload": ROW}, {"after": ROW}, ROW, {"payload": {"op": "u", "after": ROW}}]
    assert _unwrap(spark, *map(json.dumps, wrapped)) == [("upsert", 1, 1.5)] * 5


def test_deletes_show_the_row_before(spark):
    full = {"payload": {"op": "d", "before": ROW, "after": None}}
    bare = {"op": "d", "before": ROW, "after": None}
    unknown = {"payload": {"op": "d", "after": None}}
    assert _unwrap(spark, *map(json.dumps, [full, bare, unknown])) == [
        ("delete", 1, 1.5),
        ("delete", 1, 1.5),
        ("delete", None, None),
    ]


def test_bad_messages(spark):
    wrong_type = json.dumps({"after": {**ROW, "value": "oops"}})
    assert _unwrap(spark, "no json", None, "[1]", "{", "{}", ' {"event_id": 3}', wrong_type) == [
        ("invalid", None, None),
        ("invalid", None, None),
        ("invalid", None, None),
        ("invalid", None, None),
        ("invalid", None, None),
        ("upsert", 3, None),
        ("upsert", 1, None),
    ]


@pytest.fixture(scope="module")
def fitted(spark, folder):
    train = learning.prepare_events(learning.raw_events(spark, folder))
    feature_model = fit_features(train, learning.NUMERIC, learning.CATEGORICAL)
    return feature_model, LogisticRegression(featuresCol="scaled_features", maxIter=5).fit(feature_model.transform(train))


@pytest.fixture(scope="module")
def scorer(fitted):
    return Scorer(learning.RAW_SCHEMA, *fitted, learning.prepare_events, required=["event_id", "month"])


@pytest.fixture(scope="module")
def inbox(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("inbox") / "messages")
    good = learning.event_messages(learning.raw_events(spark, folder))
    bad = spark.createDataFrame(
        [("broken",), ('{"payload":{"op":"d","before":{"event_id":5},"after":null}}',), ('{"event_id":9,"event_date":"bad"}',)],
        "value string",
    )
    good.unionByName(bad).repartition(3).write.text(path)
    return path


def _run(spark, scorer, sink, inbox, offsets, files_per_batch=None):
    query = scorer.start(text_messages(spark, inbox, files_per_batch), sink, str(offsets), available_now=True)
    query.awaitTermination()
    return query


def test_stream_equals_batch_and_counts_what_it_leaves_out(spark, folder, scorer, inbox, tmp_path):
    query = _run(spark, scorer, parquet_sink(f"{tmp_path}/out"), inbox, tmp_path / "offsets", 1)
    streamed = read_scored(spark, f"{tmp_path}/out")
    columns = [*learning.RAW_SCHEMA.fieldNames(), "prediction"]
    batch = scorer.score(spark.read.text(inbox))
    assert rows(streamed, *columns) == rows(batch, *columns)
    counts = batch_counts(query)
    n = batch.count()
    assert sorted(c["batch_id"] for c in counts) == [0, 1, 2]
    total = {k: sum(c[k] for c in counts) for k in ("received", "deleted", "invalid", "valid", "scored")}
    ids = [r["event_id"] for r in spark.read.parquet(f"{folder}/events.parquet").select("event_id").collect()]
    deleted = sum(i % 47 == 0 for i in ids)
    invalid = sum(i % 43 == 0 and i % 47 != 0 for i in ids)
    expected = {"received": len(ids) + 3, "deleted": deleted + 1, "invalid": invalid + 1, "valid": n, "scored": n}
    assert total == expected and n == len(ids) - deleted - invalid


def test_a_replayed_batch_replaces_its_rows(spark, scorer, inbox, tmp_path):
    sink = parquet_sink(f"{tmp_path}/out")
    for _ in range(2):
        sink(scorer.score(spark.read.text(inbox)), 0)
    assert read_scored(spark, f"{tmp_path}/out").count() == scorer.score(spark.read.text(inbox)).count() > 0


def test_readers_see_the_old_batch_or_the_new_one(spark, tmp_path, monkeypatch):
    out = f"{tmp_path}/out"
    sink = parquet_sink(out)
    batch = spark.range(40, numPartitions=4)
    sink(batch.where("id < 7"), 0)
    sink(batch.where("id < 9"), 1)
    before = rows(read_scored(spark, out))
    assert len(before) == 16
    breaks = F.when(F.col("id") == 39, F.raise_error(F.lit("lost between files"))).otherwise(F.col("id"))
    with pytest.raises(Exception, match="lost between files"):
        sink(batch.select(breaks.cast("long").alias("id")), 1)  # some tasks have written, the last one fails
    assert rows(read_scored(spark, out)) == before

    def lost(*args):
        raise RuntimeError("lost before publishing")

    with monkeypatch.context() as patched:
        patched.setattr("tidewheel.streaming.score.publish", lost)
        with pytest.raises(RuntimeError, match="lost before publishing"):
            sink(batch, 1)  # all files are there, but nobody may read them yet
    assert rows(read_scored(spark, out)) == before
    sink(batch, 1)
    assert rows(read_scored(spark, out).where("batch_id = 1"), "id") == [(i,) for i in sorted(range(40), key=str)]
    assert read_scored(spark, out).where("batch_id = 0").count() == 7
    sink(batch.where("false"), 0)  # an empty try takes the place of a full one
    assert read_scored(spark, out).where("batch_id = 0").count() == 0


def test_a_batch_without_valid_rows(spark, scorer, tmp_path):
    spark.createDataFrame([("broken",)], "value string").write.text(f"{tmp_path}/in")
    query = _run(spark, scorer, parquet_sink(f"{tmp_path}/out"), f"{tmp_path}/in", tmp_path / "offsets")
    assert batch_counts(query) == [
        {"batch_id": 0, "received": 1, "deleted": 0, "invalid": 1, "valid": 0, "scored": 0}
    ]


def test_a_failed_batch_is_tried_again(spark, scorer, inbox, tmp_path):
    def failing(df, batch_id):
        raise RuntimeError("sink down")

    with pytest.raises(Exception, match="sink down"):
        _run(spark, scorer, failing, inbox, tmp_path / "offsets")
    _run(spark, scorer, parquet_sink(f"{tmp_path}/out"), inbox, tmp_path / "offsets")
    assert read_scored(spark, f"{tmp_path}/out").count() == scorer.score(spark.read.text(inbox)).count()


def test_jdbc_sink_appends_with_the_batch_id(spark, monkeypatch):
    """No database is started: the call that would reach one is recorded."""
    calls = []
    monkeypatch.setattr(
        "pyspark.sql.readwriter.DataFrameWriter.jdbc", lambda self, **kw: calls.append((self._df.columns, kw["table"]))
    )
    jdbc_sink("jdbc:x", "scores", {})(spark.range(1), 7)
    assert calls == [(["id", "batch_id"], "scores")]
