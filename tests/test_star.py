import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidewheel import scratch
from tidewheel.operators.star import galaxy_schema, save_bucketed
from tidewheel.plans import reports


@pytest.fixture(scope="module")
def galaxy(spark):
    day = lambda m, d: dt.datetime(2020, m, d, 5)
    data = [
        ("Cobar", day(1, 2), 1, 1.0, 10.0),
        ("Cobar", None, 2, 2.0, 20.0),
        ("Albury", day(1, 2), 3, 3.0, 30.0),
        (None, day(7, 1), 4, 4.0, 40.0),
        ("Albury", day(4, 1), 5, 5.0, 50.0),
    ]
    df = spark.createDataFrame(data, "place string, at timestamp_ntz, n int, rain double, wind double")
    return galaxy_schema(df, "place", "at", ["n"], {"rain_fact": ["rain"], "wind_fact": ["wind"]})


def test_dimensions(galaxy):
    assert rows(galaxy.entity, "place", "entity_id") == [("Albury", 1), ("Cobar", 2)]
    assert rows(galaxy.dates, "date_id", "full_date", "year", "month", "quarter", "season") == [
        (1, dt.date(2020, 1, 2), 2020, 1, 1, "Summer"),
        (2, dt.date(2020, 4, 1), 2020, 4, 2, "Autumn"),
        (3, dt.date(2020, 7, 1), 2020, 7, 3, "Winter"),
    ]


def test_facts_drop_rows_without_entity_and_keep_rows_without_date(galaxy):
    assert rows(galaxy.facts["rain_fact"], "record_id", "entity_id", "date_id", "rain") == [
        (1, 2, None, 2.0),
        (2, 1, 1, 3.0),
        (3, 2, 1, 1.0),
        (4, 1, 2, 5.0),
    ]


def test_sql_over_the_registered_tables(spark, galaxy):
    galaxy.register()
    got = spark.sql("""
        SELECT e.place, d.season, SUM(r.rain + w.wind) AS total FROM rain_fact r JOIN wind_fact w USING (record_id)
        JOIN entity_dim e ON r.entity_id = e.entity_id JOIN date_dim d ON r.date_id = d.date_id GROUP BY 1, 2""")
    assert rows(got) == [("Albury", "Autumn", 55.0), ("Albury", "Summer", 33.0), ("Cobar", "Summer", 11.0)]


def test_stored_facts_are_bucketed_alike(spark, galaxy):
    stored = galaxy.stored(4)
    both = stored.join_facts("rain_fact", "wind_fact")
    assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
    assert rows(both, "record_id", "rain", "wind") == [(1, 2.0, 20.0), (2, 3.0, 30.0), (3, 1.0, 10.0), (4, 5.0, 50.0)]
    per_record = stored.facts["rain_fact"].groupBy("record_id").agg(F.sum("rain"))
    assert "Exchange hashpartitioning" not in per_record._jdf.queryExecution().executedPlan().toString()
    names = [f.select("record_id")._jdf.queryExecution().analyzed().toString() for f in stored.facts.values()]
    assert all("tidewheel" in n for n in names)


def test_facts_of_the_query_join_without_a_shuffle(spark, folder):
    schema = reports._galaxy(spark, folder).stored()
    both = schema.join_facts("price_fact", "shipping_fact")
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_bucketed_facts_join_without_a_shuffle(spark, galaxy):
    for name, fact in galaxy.facts.items():
        save_bucketed(fact, f"bucketed_{name}", "record_id", 4)
    rain, wind = (spark.table(f"bucketed_{n}").hint("merge") for n in galaxy.facts)
    joined = rain.join(wind, "record_id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.agg(F.sum("wind")).first()[0] == 110.0
    for name in galaxy.facts:
        spark.sql(f"DROP TABLE bucketed_{name}")


def test_released_tables_leave_the_catalog(spark, galaxy):
    """The last test of this file: it deletes what the fixture has stored."""
    galaxy.stored(2)
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("tidewheel_")]
    scratch.release(spark)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("tidewheel_")]
