"""Star schema and the ten analytic reports on the order and event tables."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import functions as F

from ..functions import band, season_of
from ..operators import analytics
from ..operators.ordered import dense_id, dim_id, with_neighbours
from ..operators.star import galaxy_schema
from .tables import LINE_KEY, LINE_NATIONS_SQL, ORDER_NATIONS_SQL, line_nations, order_nations, season_sql, table


def _returned():
    return F.col("l_returnflag") == "R"


def conditional_rate(spark, folder):
    return analytics.conditional_rate(
        line_nations(spark, folder),
        ["n_name", "o_orderpriority"],
        _returned(),
        min_rows=50,
        means={"mean_quantity": (F.col("l_quantity"), 1)},
    )


def dense_surrogate_id(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderdate", "o_orderkey")
    return dense_id(orders, ["o_orderdate", "o_orderkey"], "order_id")


def dimension_id(spark, folder, **limit):
    """A dimension of all ordered parts and their first order, in the order of their keys."""
    parts = table(spark, folder, "lineitem").groupBy("l_partkey").agg(F.min("l_orderkey").alias("first_order"))
    return dim_id(parts, ["l_partkey"], "part_id", **limit)


def _galaxy(spark, folder):
    return galaxy_schema(
        line_nations(spark, folder),
        entity="n_name",
        date="o_orderdate",
        tie_break=[*LINE_KEY, "l_extendedprice"],
        facts={
            "price_fact": ["l_quantity", "l_extendedprice", "l_discount"],
            "shipping_fact": ["l_tax", "l_returnflag", "l_shipdate"],
        },
    )


def galaxy_sql(spark, folder):
    """A report in SQL over the registered tables of the schema."""
    _galaxy(spark, folder).stored().register()
    return spark.sql("""
        SELECT /*+ MERGE(s) */ e.n_name, d.season, COUNT(*) AS n, ROUND(AVG(p.l_quantity), 1) AS mean_quantity,
            COUNT_IF(s.l_returnflag = 'R') AS returned
        FROM price_fact p JOIN shipping_fact s ON p.record_id = s.record_id
        JOIN entity_dim e ON p.entity_id = e.entity_id JOIN date_dim d ON p.date_id = d.date_id
        GROUP BY e.n_name, d.season""")


def galaxy(spark, folder):
    """Row counts, key ranges, orphans and a checksum of every table of the schema."""
    schema = _galaxy(spark, folder).stored()

    def summary(name, df, key, weight):
        return df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.min(key).alias("min_key"),
            F.max(key).alias("max_key"),
            F.sum((F.col(key) % 97 * weight).cast("decimal(38,0)")).cast("double").alias("checksum"),
        )

    price, shipping = schema.facts["price_fact"], schema.facts["shipping_fact"]
    with_dims = price.join(schema.entity, "entity_id").join(schema.dates, "date_id")
    both = schema.join_facts("price_fact", "shipping_fact")
    parts = [
        summary("entity_dim", schema.entity, "entity_id", F.length("n_name")),
        summary("date_dim", schema.dates, "date_id", F.col("month") + F.col("quarter") + F.length("season")),
        summary("price_fact", price, "record_id", F.col("l_quantity")),
        summary("shipping_fact", shipping, "record_id", F.ascii("l_returnflag")),
        summary("price_with_dims", with_dims, "record_id", F.col("year") + F.length("n_name")),
        summary("joined_facts", both, "record_id", F.col("l_quantity") + F.ascii("l_returnflag")),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def period_vs_mean(spark, folder):
    return analytics.period_vs_mean(
        table(spark, folder, "orders"),
        {"year": F.year("o_orderdate")},
        F.col("o_orderstatus") == "F",
        F.col("o_totalprice"),
        high=1.01,
        low=0.99,
    )


# Most groups of the test tables have more rows than this: the queries below take the road of oversized groups.
HOT_GROUP_ROWS = 40


def rank_in_group(spark, folder, **limit):
    rows = line_nations(spark, folder).withColumn("season", season_of(F.month("o_orderdate")))
    return analytics.rank_in_group(
        rows.where(F.col("l_returnflag").isNotNull()),
        "n_name",
        "season",
        _returned(),
        {"mean_quantity": (F.col("l_quantity"), 1), "mean_price": (F.col("l_extendedprice"), 2)},
        **limit,
    )


def lag_delta_buckets(spark, folder, **limit):
    return analytics.lag_delta_buckets(
        table(spark, folder, "events"),
        ["user_id"],
        ["ts", "event_id"],
        "value",
        F.col("next_type") == "purchase",
        [(">", 5), (">", 2), (">=", 0)],
        ["4_sharp_fall", "3_fall", "2_stable", "1_rise"],
        outcome=("next_type", "event_type"),
        **limit,
    )


def decile_rate(spark, folder, **limit):
    return analytics.decile_rate(
        table(spark, folder, "lineitem"),
        ["l_returnflag"],
        "l_extendedprice",
        LINE_KEY,
        F.col("l_linestatus") == "O",
        **limit,
    )


def bucket_matrix(spark, folder):
    lines = table(spark, folder, "lineitem").join(
        table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return analytics.bucket_matrix(
        lines.where(F.col("l_returnflag").isin("A", "N", "R")),
        {
            "quantity_band": band(F.col("l_quantity"), [(">=", 40), (">=", 20)], ["3_high", "2_mid", "1_low"]),
            "discount_band": band(F.col("l_discount"), [("<", 0.03), ("<", 0.07)], ["1_low", "2_mid", "3_high"]),
        },
        F.col("o_orderstatus") == "F",
        min_rows=500,
    )


def ytd_running_sum(spark, folder):
    return analytics.ytd_running_sum(
        order_nations(spark, folder), ["n_name"], "o_orderdate", "o_totalprice", {1996: "first", 1998: "second"}
    )


def longest_runs(spark, folder, **limit):
    events = table(spark, folder, "events")
    keep = F.col("event_type") != "error"
    return analytics.longest_runs(events, ["user_id"], ["ts", "event_id"], keep, min_length=5, **limit)


def longest_calendar_runs(spark, folder):
    """Longest spells of consecutive days with events but without an error, per user."""
    daily = (
        table(spark, folder, "events")
        .groupBy("user_id", F.to_date("ts").alias("day"))
        .agg(F.count_if(F.col("event_type") == "error").alias("errors"))
    )
    return analytics.longest_runs(daily, ["user_id"], ["day"], F.col("errors") == 0, min_length=3, calendar=True)


def persistence_rate(spark, folder):
    rows = with_neighbours(
        table(spark, folder, "events"), ["user_id"], ["ts", "event_id"], following={"next_type": "event_type"}
    )
    return analytics.persistence_rate(
        rows.where(F.col("next_type").isNotNull()),
        ["user_id"],
        F.col("event_type") == "purchase",
        F.col("next_type") == "purchase",
        min_rows=60,
    )


def league_table(spark, folder, **limit):
    return analytics.league_table(
        line_nations(spark, folder),
        "n_name",
        {
            "mean_quantity": (F.col("l_quantity"), 1),
            "mean_price": (F.col("l_extendedprice"), 1),
            "mean_discount": (F.col("l_discount"), 4),
            "mean_tax": (F.col("l_tax"), 4),
            "mean_order": (F.col("o_totalprice"), 1),
            "mean_balance": (F.col("c_acctbal"), 2),
        },
        {"total_price": (F.col("l_extendedprice").cast("decimal(18,2)"), 0)},
        _returned(),
        **limit,
    )


QUERIES = {
    "conditional_rate": conditional_rate,
    "dense_surrogate_id": dense_surrogate_id,
    "dimension_id": dimension_id,
    "dimension_id_hot": partial(dimension_id, max_group_rows=HOT_GROUP_ROWS),
    "galaxy_schema": galaxy,
    "galaxy_sql": galaxy_sql,
    "period_vs_mean": period_vs_mean,
    "rank_in_group": rank_in_group,
    "lag_delta_buckets": lag_delta_buckets,
    "decile_rate": decile_rate,
    "bucket_matrix": bucket_matrix,
    "ytd_running_sum": ytd_running_sum,
    "longest_runs": longest_runs,
    "longest_calendar_runs": longest_calendar_runs,
    "persistence_rate": persistence_rate,
    "league_table": league_table,
    "league_table_hot": partial(league_table, max_group_rows=2),
    "rank_in_group_hot": partial(rank_in_group, max_group_rows=2),
    "lag_delta_buckets_hot": partial(lag_delta_buckets, max_group_rows=HOT_GROUP_ROWS),
    "decile_rate_hot": partial(decile_rate, max_group_rows=HOT_GROUP_ROWS),
    "longest_runs_hot": partial(longest_runs, max_group_rows=HOT_GROUP_ROWS),
}


def _rates(condition: str) -> str:
    return f"""COUNT(*) AS n, COUNT(*) FILTER (WHERE {condition}) AS hits,
        ROUND(CAST(100.0 AS DOUBLE) * COUNT(*) FILTER (WHERE {condition}) / COUNT(*), 1) AS hit_pct"""


_LINE_ORDER = "l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate"

ORACLES = {
    "conditional_rate": f"""
        SELECT n_name, o_orderpriority, {_rates("l_returnflag = 'R'")}, ROUND(AVG(l_quantity), 1) AS mean_quantity
        FROM {LINE_NATIONS_SQL}
        GROUP BY n_name, o_orderpriority HAVING COUNT(*) >= 50""",
    "dense_surrogate_id": """
        SELECT o_orderdate, o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS order_id FROM orders""",
    "dimension_id": """
        SELECT l_partkey, MIN(l_orderkey) AS first_order, ROW_NUMBER() OVER (ORDER BY l_partkey) AS part_id
        FROM lineitem GROUP BY l_partkey""",
    "galaxy_schema": f"""
        WITH flat AS (SELECT *, CAST(o_orderdate AS DATE) AS full_date FROM {LINE_NATIONS_SQL}),
        entity_dim AS (SELECT n_name, ROW_NUMBER() OVER (ORDER BY n_name) AS entity_id
            FROM (SELECT DISTINCT n_name FROM flat)),
        date_dim AS (SELECT full_date, year(full_date) AS y, month(full_date) AS m, quarter(full_date) AS q,
                {season_sql("month(full_date)")} AS season,
                ROW_NUMBER() OVER (ORDER BY full_date) AS date_id
            FROM (SELECT DISTINCT full_date FROM flat)),
        fact AS (SELECT f.*, d.y, ROW_NUMBER() OVER (ORDER BY full_date, n_name, l_orderkey, l_linenumber,
                l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS record_id
            FROM flat f JOIN date_dim d USING (full_date)),
        cells AS (
            SELECT 'entity_dim' AS table_name, entity_id AS k, length(n_name) AS w FROM entity_dim
            UNION ALL SELECT 'date_dim', date_id, m + q + length(season) FROM date_dim
            UNION ALL SELECT 'price_fact', record_id, l_quantity FROM fact
            UNION ALL SELECT 'shipping_fact', record_id, ascii(l_returnflag) FROM fact
            UNION ALL SELECT 'price_with_dims', record_id, y + length(n_name) FROM fact
            UNION ALL SELECT 'joined_facts', record_id, l_quantity + ascii(l_returnflag) FROM fact)
        SELECT table_name, COUNT(*) AS n_rows, MIN(k) AS min_key, MAX(k) AS max_key,
            CAST(SUM(CAST(k % 97 * w AS DECIMAL(38,0))) AS DOUBLE) AS checksum
        FROM cells GROUP BY table_name""",
    "galaxy_sql": f"""
        SELECT n_name, {season_sql("month(o_orderdate)")} AS season, COUNT(*) AS n, ROUND(AVG(l_quantity), 1) AS mean_quantity,
            COUNT(*) FILTER (WHERE l_returnflag = 'R') AS returned
        FROM {LINE_NATIONS_SQL} GROUP BY 1, 2""",
    "period_vs_mean": f"""
        WITH yearly AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {_rates("o_orderstatus = 'F'")},
                ROUND(AVG(o_totalprice), 2) AS mean_value
            FROM orders GROUP BY 1),
        overall AS (SELECT AVG(mean_value) AS m FROM yearly)
        SELECT year, n, hits, hit_pct, mean_value, ROUND(m, 2) AS overall_mean, ROUND(mean_value - m, 2) AS deviation,
            CASE WHEN mean_value > m * CAST(1.01 AS DOUBLE) THEN 'above'
                 WHEN mean_value < m * CAST(0.99 AS DOUBLE) THEN 'below' ELSE 'normal' END AS verdict
        FROM yearly, overall""",
    "rank_in_group": f"""
        WITH g AS (SELECT n_name, {season_sql("month(o_orderdate)")} AS season, {_rates("l_returnflag = 'R'")},
                CAST(100.0 AS DOUBLE) * COUNT(*) FILTER (WHERE l_returnflag = 'R') / COUNT(*) AS exact,
                ROUND(AVG(l_quantity), 1) AS mean_quantity, ROUND(AVG(l_extendedprice), 2) AS mean_price
            FROM {LINE_NATIONS_SQL} WHERE l_returnflag IS NOT NULL GROUP BY 1, 2)
        SELECT n_name, season, n, hits, hit_pct, mean_quantity, mean_price,
            CAST(RANK() OVER (PARTITION BY n_name ORDER BY exact DESC) AS INTEGER) AS rank_in_group
        FROM g""",
    "lag_delta_buckets": f"""
        WITH e AS (SELECT LAG(value) OVER w - value AS fall, LEAD(event_type) OVER w AS next_type
            FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
        SELECT CASE WHEN fall > 5 THEN '4_sharp_fall' WHEN fall > 2 THEN '3_fall' WHEN fall >= 0 THEN '2_stable'
            ELSE '1_rise' END AS change_band, {_rates("next_type = 'purchase'")}
        FROM e WHERE fall IS NOT NULL AND next_type IS NOT NULL GROUP BY 1""",
    "decile_rate": f"""
        WITH t AS (SELECT *, NTILE(10) OVER (PARTITION BY l_returnflag ORDER BY {_LINE_ORDER}) AS bucket FROM lineitem)
        SELECT l_returnflag, CAST(bucket AS INTEGER) AS bucket, MIN(l_extendedprice) AS min_value,
            MAX(l_extendedprice) AS max_value, COUNT(*) AS n,
            ROUND(CAST(100.0 AS DOUBLE) * COUNT(*) FILTER (WHERE l_linestatus = 'O') / COUNT(*), 1) AS hit_pct,
            CASE WHEN CAST(100.0 AS DOUBLE) * COUNT(*) FILTER (WHERE l_linestatus = 'O') / COUNT(*) >= 50
                THEN 'alert' ELSE '' END AS alert
        FROM t GROUP BY l_returnflag, bucket""",
    "bucket_matrix": f"""
        SELECT CASE WHEN l_quantity >= 40 THEN '3_high' WHEN l_quantity >= 20 THEN '2_mid' ELSE '1_low' END
                AS quantity_band,
            CASE WHEN l_discount < 0.03 THEN '1_low' WHEN l_discount < 0.07 THEN '2_mid' ELSE '3_high' END
                AS discount_band, {_rates("o_orderstatus = 'F'")}
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_returnflag IN ('A', 'N', 'R') GROUP BY 1, 2 HAVING COUNT(*) >= 500""",
    "ytd_running_sum": f"""
        WITH daily AS (SELECT n_name, CAST(o_orderdate AS DATE) AS full_date,
                SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS amount
            FROM {ORDER_NATIONS_SQL} GROUP BY 1, 2)
        SELECT n_name, CAST(year(full_date) AS INTEGER) AS year, full_date, CAST(month(full_date) AS INTEGER) AS month,
            CAST(dayofyear(full_date) AS INTEGER) AS day_of_year, CAST(ROUND(amount, 1) AS DOUBLE) AS day_amount,
            CAST(ROUND(SUM(amount) OVER (PARTITION BY n_name, year(full_date) ORDER BY full_date
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1) AS DOUBLE) AS ytd_amount,
            CASE year(full_date) WHEN 1996 THEN 'first' WHEN 1998 THEN 'second' END AS year_tag
        FROM daily""",
    "longest_runs": """
        WITH r AS (SELECT user_id, ts, event_type <> 'error' AS ok,
                ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id)
                - ROW_NUMBER() OVER (PARTITION BY user_id, event_type <> 'error' ORDER BY ts, event_id) AS island
            FROM events),
        runs AS (SELECT user_id, MIN(ts) AS run_start, MAX(ts) AS run_end, COUNT(*) AS run_rows
            FROM r WHERE ok GROUP BY user_id, island HAVING COUNT(*) >= 5)
        SELECT *, CAST(DENSE_RANK() OVER (ORDER BY run_rows DESC) AS INTEGER) AS length_rank
        FROM runs ORDER BY run_rows DESC, user_id, run_start LIMIT 15""",
    "longest_calendar_runs": """
        WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) FILTER (WHERE event_type = 'error') AS errors
            FROM events GROUP BY 1, 2),
        clean AS (SELECT user_id, day, day - CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER)
                AS island FROM daily WHERE errors = 0),
        runs AS (SELECT user_id, MIN(day) AS run_start, MAX(day) AS run_end, COUNT(*) AS run_rows
            FROM clean GROUP BY user_id, island HAVING COUNT(*) >= 3)
        SELECT *, CAST(DENSE_RANK() OVER (ORDER BY run_rows DESC) AS INTEGER) AS length_rank
        FROM runs ORDER BY run_rows DESC, user_id, run_start LIMIT 15""",
    "persistence_rate": """
        WITH e AS (SELECT user_id, event_type,
                LEAD(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type FROM events)
        SELECT user_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE event_type = 'purchase') AS now_hits,
            COUNT(*) FILTER (WHERE event_type = 'purchase' AND next_type = 'purchase') AS both_hits,
            ROUND(CAST(100.0 AS DOUBLE) * COUNT(*) FILTER (WHERE event_type = 'purchase' AND next_type = 'purchase')
                / NULLIF(COUNT(*) FILTER (WHERE event_type = 'purchase'), 0), 1) AS persistence_pct
        FROM e WHERE next_type IS NOT NULL GROUP BY user_id HAVING COUNT(*) >= 60""",
    "league_table": f"""
        WITH g AS (SELECT n_name, COUNT(*) AS n, ROUND(AVG(l_quantity), 1) AS mean_quantity,
                ROUND(AVG(l_extendedprice), 1) AS mean_price, ROUND(AVG(l_discount), 4) AS mean_discount,
                ROUND(AVG(l_tax), 4) AS mean_tax, ROUND(AVG(o_totalprice), 1) AS mean_order,
                ROUND(AVG(c_acctbal), 2) AS mean_balance,
                CAST(ROUND(SUM(CAST(l_extendedprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_price,
                CAST(100.0 AS DOUBLE) * COUNT(*) FILTER (WHERE l_returnflag = 'R') / COUNT(*) AS exact
            FROM {LINE_NATIONS_SQL} GROUP BY n_name)
        SELECT n_name, n, mean_quantity, mean_price, mean_discount, mean_tax, mean_order, mean_balance, total_price,
            ROUND(exact, 1) AS hit_pct, CAST(RANK() OVER (ORDER BY exact DESC) AS INTEGER) AS overall_rank
        FROM g""",
}

_HOT = ("rank_in_group", "lag_delta_buckets", "decile_rate", "longest_runs", "dimension_id", "league_table")
ORACLES |= {f"{name}_hot": ORACLES[name] for name in _HOT}
