import pytest
from pyspark.errors import AnalysisException

from helpers import rows
from tidewheel import scratch
from tidewheel.session import cluster_conf
from tidewheel.sources import jdbc_options, kafka_messages, preview, read_csv, write_csv, write_jdbc, write_parquet
from tidewheel.sources.jdbc import latest_batch


def test_csv_keeps_types_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", 1.5), (2, None, None), (None, "NA,y", 2.0)], "a int, b string, c double")
    write_csv(df, f"{tmp_path}/csv", single_file=True)
    back = read_csv(spark, f"{tmp_path}/csv", df.schema)
    assert back.schema == df.schema and rows(back) == rows(df)
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 1


def test_parquet_is_overwritten_and_partitioned(spark, tmp_path):
    for n in (5, 3):
        write_parquet(spark.range(n).selectExpr("id", "id % 2 AS half"), f"{tmp_path}/p", ["half"], 1)
    assert spark.read.parquet(f"{tmp_path}/p").count() == 3
    assert len(list((tmp_path / "p" / "half=0").glob("*.parquet"))) == 2


def test_preview_gives_first_rows_and_full_count(spark):
    first, total = preview(spark.range(2500), 10)
    assert (len(first), total) == (10, 2500)


def test_preview_runs_the_query_once(spark):
    """Rows that pass through the query are counted: no more than the query has."""
    passed = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    wide = spark.range(2500, numPartitions=7).selectExpr("id", "map('k', id) AS m", "array(id) AS a")
    first, total = preview(wide.mapInArrow(look, wide.schema), 1000)
    assert [r["id"] for r in first] == list(range(1000)) and first[7]["m"] == {"k": 7} and total == 2500
    assert passed.value == 2500


def test_preview_of_short_and_late_results(spark):
    assert preview(spark.range(0), 10) == ([], 0)
    assert preview(spark.range(5), 0) == ([], 5)
    late = spark.range(2000, numPartitions=20).where("id >= 1900")
    first, total = preview(late, 10, parts=3)  # the first partitions hold none
    assert ([r["id"] for r in first], total) == (list(range(1900, 1910)), 100)
    ordered = spark.range(100, numPartitions=5).orderBy("id", ascending=False)
    assert [r["id"] for r in preview(ordered, 3)[0]] == [99, 98, 97]


def test_jdbc_settings_come_from_the_environment():
    env = {"JDBC_URL": "jdbc:x", "JDBC_USER": "u", "JDBC_PASSWORD": "p"}
    assert jdbc_options(env) == ("jdbc:x", {"user": "u", "password": "p"})
    with pytest.raises(KeyError):
        jdbc_options({})


def test_jdbc_write_adds_the_batch_id(spark, monkeypatch):
    """No database is started here: the call that would reach one is recorded instead."""
    calls = []
    monkeypatch.setattr(
        "pyspark.sql.readwriter.DataFrameWriter.jdbc", lambda self, **kw: calls.append((self._df.columns, kw))
    )
    write_jdbc(spark.range(1), "jdbc:x", "t", {"user": "u"}, batch_id=4)
    assert calls == [(["id", "batch_id"], {"url": "jdbc:x", "table": "t", "mode": "append", "properties": {"user": "u"}})]


def test_dedup_view_hides_replays(spark):
    df = spark.createDataFrame([(1, 0.0, 3), (1, 0.0, 3), (2, 1.0, 3), (2, 0.0, 4)], "id int, prediction double, batch_id long")
    assert rows(latest_batch(df, "id"), "id", "prediction") == [(1, 0.0), (2, 0.0)]


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        kafka_messages(spark, "host:1", "topic")


def test_scratch_tables_are_written_to_the_checkpoint_folder_and_released(spark):
    stored = scratch.materialise(spark.range(3))
    assert stored.count() == 3
    assert spark.conf.get("spark.checkpoint.dir", None) is None or stored.inputFiles()[0].split(":", 1)[1].lstrip(
        "/"
    ).startswith(scratch.scratch_root(spark).split(":", 1)[-1].lstrip("/"))
    assert scratch.release(spark) >= 1


def test_partitions_grow_with_the_input():
    assert cluster_conf(10 << 30, 8)["spark.sql.shuffle.partitions"] == "40"
    large = cluster_conf(100 << 40, 4000)
    assert int(large["spark.sql.shuffle.partitions"]) == 20_000
    assert int(large["spark.sql.files.maxPartitionBytes"]) == 512 << 20
    assert cluster_conf(1 << 20, 8)["spark.sql.shuffle.partitions"] == "16"
