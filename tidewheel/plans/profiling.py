"""Profiling queries on the event, order and line tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import neighbours, profile, quantile_state
from ..operators.clean import drop_sparse_columns as drop_sparse
from ..scratch import materialise
from .tables import NULLED_EVENT_COLUMNS, NULLED_EVENTS_SQL, nulled_events, table

LINE_NUMBERS = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
}
FREQUENCY_COLUMNS = ["event_type", "props", "user_id"]
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DERIVED = {
    "net_price": "l_extendedprice * (1 - l_discount)",
    "charge": "l_extendedprice * (1 - l_discount) * (1 + l_tax)",
}


def _lines(spark, folder):
    return table(spark, folder, "lineitem")


def _repeated_events(spark, folder):
    events = table(spark, folder, "events")
    return events.unionAll(events.where(F.col("event_type") == "error"))


def _rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def missing_profile(spark, folder):
    return profile.missing_profile(nulled_events(spark, folder))


def missing_severity(spark, folder):
    return profile.missing_severity(nulled_events(spark, folder))


def drop_sparse_columns(spark, folder):
    return drop_sparse(nulled_events(spark, folder), 30.0)


STATE_PROBABILITIES = [0.0, 0.1, 0.5, 0.9, 1.0]
RANK_TOLERANCE = 0.01  # 3.6 times the error that a sketch keeps to with a probability of 0.99


def merged_quantiles(spark, folder):
    """Sketches per ship month and return flag, stored and then merged per flag: counts, ends and true ranks of the answers."""
    lines = _lines(spark, folder)
    months = lines.withColumn("month", F.trunc("l_shipdate", "month"))
    state = materialise(quantile_state.quantile_state(months, ["month", "l_returnflag"], MEASURES), "sketches")
    merged = quantile_state.merge_state(state, ["l_returnflag"], MEASURES)
    found = quantile_state.state_quantiles(merged, ["l_returnflag"], MEASURES, STATE_PROBABILITIES)
    found = materialise(found, "quantiles")  # a row per flag and column
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in MEASURES])
    values = lines.select("l_returnflag", F.inline(cells))
    asked = range(len(STATE_PROBABILITIES))
    ranks = values.join(found, ["l_returnflag", "column"]).groupBy("l_returnflag", "column", "n", "quantiles").agg(
        F.array(*[F.count_if(F.col("value") < F.col("quantiles")[i]) for i in asked]).alias("below"),
        F.array(*[F.count_if(F.col("value") <= F.col("quantiles")[i]) for i in asked]).alias("upto"),
    )
    slack = F.col("n") * RANK_TOLERANCE
    close = [
        (F.col("below")[i] <= F.col("n") * p + slack) & (F.col("upto")[i] >= F.col("n") * p - slack)
        for i, p in enumerate(STATE_PROBABILITIES)
    ]
    return ranks.select(
        "l_returnflag",
        F.col("column").alias("measure"),
        "n",
        F.col("quantiles")[0].alias("least"),
        F.col("quantiles")[len(asked) - 1].alias("greatest"),
        F.array_min(F.array(*close)).alias("ranks_hold"),
    )


def dup_profile(spark, folder):
    return profile.dup_profile(_repeated_events(spark, folder))


def cardinality_profile(spark, folder):
    return profile.cardinality_profile(nulled_events(spark, folder))


def frequency_table(spark, folder):
    return profile.frequency_table(nulled_events(spark, folder), FREQUENCY_COLUMNS, top=30)


def class_balance(spark, folder):
    return profile.class_balance(nulled_events(spark, folder), "event_type")


def describe_profile(spark, folder):
    return profile.describe_profile(_lines(spark, folder))


def median_profile(spark, folder):
    return profile.median_profile(_lines(spark, folder))


def box_stats(spark, folder):
    return _rounded(profile.box_stats(_lines(spark, folder)), 6, "q1", "median", "q3")


def corr_matrix(spark, folder):
    return _rounded(profile.corr_matrix(_lines(spark, folder)), 6, "r")


def mutual_info(spark, folder):
    returned = (F.col("l_returnflag") == "R").cast("int")
    return _rounded(profile.mutual_info(_lines(spark, folder), MEASURES, returned), 8, "mi")


NEIGHBOUR_FEATURES = {
    "value": "CASE WHEN event_id % 13 <> 0 THEN value END",
    "minute": "hour(ts) * 60 + minute(ts)",
    "user_id": "user_id",
    "noise": "event_id * 7919 % 10007",
}


def mutual_info_knn(spark, folder):
    """Nearest-neighbour information of event columns on the type of the event, in slices however short the table."""
    events = table(spark, folder, "events").selectExpr("event_type", *[f"{e} AS {n}" for n, e in NEIGHBOUR_FEATURES.items()])
    found = neighbours.mutual_info_neighbours(events, list(NEIGHBOUR_FEATURES), F.col("event_type"), k=3)
    return _rounded(found, 8, "mi")


def select_features(spark, folder):
    lines = _lines(spark, folder).withColumns({n: F.expr(e) for n, e in DERIVED.items()})
    returned = (F.col("l_returnflag") == "R").cast("int")
    chosen = profile.select_features(lines, [*MEASURES, *DERIVED], returned, max_abs_corr=0.8)
    return _rounded(chosen, 8, "mi")


def monthly_means(spark, folder):
    return profile.monthly_means(table(spark, folder, "orders"), "o_orderdate", ["o_totalprice"], digits=2)


def top_entities(spark, folder):
    return profile.top_entities(table(spark, folder, "orders"), "o_custkey", "o_totalprice", top=10, digits=2)


QUERIES = {
    "merged_quantiles": merged_quantiles,
    "missing_profile": missing_profile,
    "missing_severity": missing_severity,
    "drop_sparse_columns": drop_sparse_columns,
    "dup_profile": dup_profile,
    "cardinality_profile": cardinality_profile,
    "frequency_table": frequency_table,
    "class_balance": class_balance,
    "describe_profile": describe_profile,
    "median_profile": median_profile,
    "box_stats": box_stats,
    "corr_matrix": corr_matrix,
    "mutual_info": mutual_info,
    "mutual_info_knn": mutual_info_knn,
    "select_features": select_features,
    "monthly_means": monthly_means,
    "top_entities": top_entities,
}


def _union(parts):
    return "\n        UNION ALL ".join(parts)


def _missing_sql():
    return _union(
        f"""SELECT '{c}' AS "column", COUNT(*) FILTER (WHERE {c} IS NULL) AS missing,
            ROUND(CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / COUNT(*) * 100, 2) AS missing_pct FROM nulled"""
        for c in NULLED_EVENT_COLUMNS
    )


def _describe_sql():
    numbers = (
        f"""SELECT '{c}' AS "column", '{t}' AS data_type, TRUE AS nullable, COUNT({c}) AS non_null,
            ROUND(AVG(CAST({c} AS DOUBLE)), 4) AS mean, ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 4) AS stddev,
            ROUND(MIN(CAST({c} AS DOUBLE)), 4) AS min_value, ROUND(MAX(CAST({c} AS DOUBLE)), 4) AS max_value,
            CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM lineitem"""
        for c, t in LINE_NUMBERS.items()
    )
    texts = (
        f"SELECT '{c}', 'string', TRUE, COUNT({c}), NULL, NULL, NULL, NULL, MIN({c}), MAX({c}) FROM lineitem"
        for c in ("l_returnflag", "l_linestatus")
    )
    dates = [
        """SELECT 'l_shipdate', 'timestamp_ntz', TRUE, COUNT(l_shipdate), NULL, NULL, NULL, NULL,
            CAST(MIN(l_shipdate) AS VARCHAR), CAST(MAX(l_shipdate) AS VARCHAR) FROM lineitem"""
    ]
    return _union([*numbers, *texts, *dates])


def _box_sql():
    return _union(
        f"""SELECT '{c}' AS "column", ROUND(q[1], 6) AS q1, ROUND(q[2], 6) AS median, ROUND(q[3], 6) AS q3,
            MIN(CAST({c} AS DOUBLE)) FILTER (WHERE {c} >= q[1] - 1.5 * (q[3] - q[1])) AS whisker_low,
            MAX(CAST({c} AS DOUBLE)) FILTER (WHERE {c} <= q[3] + 1.5 * (q[3] - q[1])) AS whisker_high,
            COUNT(*) FILTER (WHERE {c} < q[1] - 1.5 * (q[3] - q[1]) OR {c} > q[3] + 1.5 * (q[3] - q[1])) AS outliers
        FROM lineitem, (SELECT quantile_cont(CAST({c} AS DOUBLE), [0.25, 0.5, 0.75]) AS q FROM lineitem) GROUP BY q"""
        for c in LINE_NUMBERS
    )


def _corr_sql():
    names = list(LINE_NUMBERS)
    return _union(
        f"SELECT '{x}' AS x, '{y}' AS y, ROUND(corr({y}, {x}), 6) AS r FROM lineitem"
        for i, x in enumerate(names)
        for y in names[:i]
    )


def _mi_ctes(features):
    """CTEs down to ``mi(feature, mi)`` over a relation ``src`` with a 0/1 column ``label``."""
    cells = _union(f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS v, label FROM src" for f in features)
    bins = " + ".join(f"CAST(v > q[{i}] AS INTEGER)" for i in range(1, 10))
    return f"""cells AS ({cells}),
        cuts AS (SELECT feature, quantile_disc(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q
            FROM cells GROUP BY feature),
        binned AS (SELECT feature, label, {bins} AS bin FROM cells JOIN cuts USING (feature)),
        joint AS (SELECT feature, bin, label, COUNT(*) AS n FROM binned GROUP BY ALL),
        mi AS (SELECT feature, SUM(n / t * ln(n * t / (b * l))) AS mi FROM (
            SELECT feature, CAST(n AS DOUBLE) AS n, CAST(SUM(n) OVER (PARTITION BY feature) AS DOUBLE) AS t,
                CAST(SUM(n) OVER (PARTITION BY feature, bin) AS DOUBLE) AS b,
                CAST(SUM(n) OVER (PARTITION BY feature, label) AS DOUBLE) AS l FROM joint) GROUP BY feature)"""


def _neighbour_sql(k=3):
    """Distances of all pairs of distinct values; the k + 1 smallest of a value include its own 0."""
    cells = _union(f"SELECT '{f}' AS feature, CAST({e} AS DOUBLE) AS v, event_type AS y FROM events" for f, e in NEIGHBOUR_FEATURES.items())
    return f"""
        WITH cells AS ({cells}),
        counted AS (SELECT feature, y, v, COUNT(*) AS n, SUM(COUNT(*)) OVER (PARTITION BY feature, y) AS n_y
            FROM cells WHERE v IS NOT NULL GROUP BY feature, y, v),
        used AS (SELECT *, LEAST({k}, n_y - 1) AS k_y FROM counted WHERE n_y > 1),
        copies AS (SELECT feature, y, v, unnest(range(LEAST(n, {k} + 1))) AS c FROM used),
        nearest AS (SELECT a.feature, a.y, a.v, MIN(abs(a.v - b.v), {k} + 1) AS d
            FROM used a JOIN copies b ON a.feature = b.feature AND a.y = b.y GROUP BY a.feature, a.y, a.v),
        radius AS (SELECT u.*, d[CAST(k_y + 1 AS INT)] AS r FROM used u JOIN nearest USING (feature, y, v)),
        points AS (SELECT feature, v, SUM(n) AS n FROM used GROUP BY ALL),
        inside AS (SELECT a.feature, a.y, a.v, SUM(p.n) AS m FROM radius a JOIN points p ON a.feature = p.feature
                AND p.v >= a.v - a.r * 1.001 - 1e-9 AND p.v <= a.v + a.r * 1.001 + 1e-9
            WHERE CASE WHEN r > 0 THEN abs(a.v - p.v) < r ELSE a.v = p.v END GROUP BY a.feature, a.y, a.v),
        psi AS (SELECT i + 1 AS i, COALESCE(SUM(1.0 / CASE WHEN i > 0 THEN i END) OVER (ORDER BY i), 0) - 0.5772156649015329 AS p
            FROM (SELECT CAST(unnest(range((SELECT CAST(COUNT(*) AS BIGINT) FROM events))) AS DOUBLE) AS i))
        SELECT feature, ROUND(GREATEST(0, any_value(pt.p) + SUM(n * (pk.p - py.p - pm.p)) / any_value(total)), 8) AS mi,
            CAST(any_value(total) AS BIGINT) AS n
        FROM radius JOIN inside USING (feature, y, v) JOIN (SELECT feature, SUM(n) AS total FROM used GROUP BY feature) USING (feature)
        JOIN psi pk ON pk.i = k_y JOIN psi py ON py.i = n_y JOIN psi pm ON pm.i = m JOIN psi pt ON pt.i = total
        GROUP BY feature"""


def _select_features_sql():
    features = [*MEASURES, *DERIVED]
    derived = ", ".join(f"{e} AS {n}" for n, e in DERIVED.items())
    pairs = _union(
        f"SELECT '{x}' AS x, '{y}' AS y, corr({y}, {x}) AS r FROM src"
        for i, x in enumerate(features)
        for y in features[:i]
    )
    return f"""
        WITH src AS (SELECT *, {derived}, CAST(l_returnflag = 'R' AS INTEGER) AS label FROM lineitem),
        {_mi_ctes(features)},
        strong AS (SELECT * FROM ({pairs}) WHERE abs(r) >= 0.8),
        dropped AS (SELECT DISTINCT CASE WHEN a.mi < b.mi OR (a.mi = b.mi AND x > y) THEN x ELSE y END AS feature
            FROM strong JOIN mi a ON x = a.feature JOIN mi b ON y = b.feature)
        SELECT feature, ROUND(mi, 8) AS mi, feature NOT IN (SELECT feature FROM dropped) AS kept FROM mi"""


ORACLES = {
    "merged_quantiles": " UNION ALL ".join(
        f"SELECT l_returnflag, '{c}' AS measure, COUNT({c}) AS n, MIN({c}) AS least, MAX({c}) AS greatest, TRUE AS ranks_hold "
        f"FROM lineitem GROUP BY l_returnflag"
        for c in MEASURES
    ),
    "missing_profile": f"WITH {NULLED_EVENTS_SQL} {_missing_sql()}",
    "missing_severity": f"""
        WITH {NULLED_EVENTS_SQL}, p AS ({_missing_sql()})
        SELECT *, CASE WHEN missing_pct = 0 THEN 'No Missing' WHEN missing_pct < 5 THEN 'Low Missing'
            WHEN missing_pct < 30 THEN 'Moderate Missing' WHEN missing_pct < 50 THEN 'High Missing'
            ELSE 'Critical Missing' END AS severity FROM p""",
    "drop_sparse_columns": f"WITH {NULLED_EVENTS_SQL} SELECT event_id, ts, user_id, event_type, value, level FROM nulled",
    "dup_profile": """
        WITH r AS (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_type = 'error')
        SELECT (SELECT COUNT(*) FROM r) AS total_rows, CAST(6 AS BIGINT) AS total_columns,
            (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM r)) AS distinct_rows,
            (SELECT COUNT(*) FROM r) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM r)) AS duplicate_rows""",
    "cardinality_profile": f"WITH {NULLED_EVENTS_SQL} "
    + _union(
        f"""SELECT '{c}' AS "column", COUNT(*) AS distinct_values FROM (SELECT DISTINCT {c} FROM nulled)"""
        for c in NULLED_EVENT_COLUMNS
    ),
    "frequency_table": f"WITH {NULLED_EVENTS_SQL} SELECT * FROM ("
    + _union(
        f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, COUNT(*) AS n, CAST(ROW_NUMBER() OVER
            (ORDER BY COUNT(*) DESC, CAST({c} AS VARCHAR) NULLS FIRST) AS INTEGER) AS position FROM nulled GROUP BY {c}"""
        for c in FREQUENCY_COLUMNS
    )
    + ") WHERE position <= 30",
    "class_balance": f"""
        WITH {NULLED_EVENTS_SQL} SELECT event_type, COUNT(*) AS n,
            ROUND(CAST(100.0 AS DOUBLE) * COUNT(*) / (SELECT COUNT(*) FROM nulled), 2) AS share_pct
        FROM nulled GROUP BY event_type""",
    "describe_profile": _describe_sql(),
    "median_profile": _union(
        f"""SELECT '{c}' AS "column", CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS median FROM lineitem"""
        for c in LINE_NUMBERS
    ),
    "box_stats": _box_sql(),
    "corr_matrix": _corr_sql(),
    "mutual_info": f"""
        WITH src AS (SELECT *, CAST(l_returnflag = 'R' AS INTEGER) AS label FROM lineitem), {_mi_ctes(MEASURES)}
        SELECT feature, ROUND(mi, 8) AS mi FROM mi""",
    "mutual_info_knn": _neighbour_sql(),
    "select_features": _select_features_sql(),
    "monthly_means": """
        SELECT CAST(month(o_orderdate) AS INTEGER) AS month, ROUND(AVG(o_totalprice), 2) AS avg_o_totalprice
        FROM orders GROUP BY 1""",
    "top_entities": """
        SELECT o_custkey, ROUND(m, 2) AS avg_o_totalprice
        FROM (SELECT o_custkey, AVG(o_totalprice) AS m FROM orders GROUP BY o_custkey)
        ORDER BY m DESC, o_custkey LIMIT 10""",
}
