"""Every query with a SQL twin gives DuckDB's rows; every other one gives rows."""

import duckdb
import pytest

import __spark_entry__ as entry_points

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _normal(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in data)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_matches_sql(spark, duck, folder, name):
    df = entry_points.queries()[name](spark, folder)
    result = duck.execute(entry_points.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    expected = _normal(columns, result.fetchall())
    assert expected, "an empty result proves nothing"
    assert _normal(df.columns, [tuple(r) for r in df.collect()]) == expected


@pytest.mark.parametrize("name", sorted(set(entry_points.queries()) - set(entry_points.oracle_sql())))
def test_other_queries_give_rows(spark, folder, name):
    assert entry_points.queries()[name](spark, folder).count() > 0


def test_every_oracle_has_a_query_and_entry_runs(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert entry_points.entry(spark).count() > 0
