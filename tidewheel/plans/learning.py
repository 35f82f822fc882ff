"""Feature, metric, model and streaming queries."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import evaluate, features, models, split
from ..scratch import materialise, scratch_path
from ..sources import text_messages
from ..streaming import Scorer, parquet_sink, prepare_rows, read_scored
from .tables import LINE_KEY, table

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# A noisy rule as label: no single column separates the classes.
LABEL_SQL = "CASE WHEN value > 20 AND event_id * 7919 % 100 < 70 THEN 1.0 ELSE 0.0 END"


def string_index(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "props")
    return features.string_index(events, ["event_type", "props"])


def frequency_index(spark, folder):
    return features.frequency_index(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), "o_custkey")


def one_hot(spark, folder):
    encoded = features.one_hot(table(spark, folder, "events").select("event_id", "event_type"), ["event_type"])
    digits = F.transform(vector_to_array("event_type_ohe"), lambda x: x.cast("int").cast("string"))
    return encoded.select("event_id", "event_type", F.array_join(digits, ",").alias("one_hot"))


def assemble_scale(spark, folder):
    lines = table(spark, folder, "lineitem").select(*LINE_KEY, *MEASURES)
    scaled = features.assemble_scale(lines, MEASURES).withColumn("v", vector_to_array("scaled_features"))
    return scaled.select(*LINE_KEY, *[F.round(F.col("v")[i], 6).alias(f"scaled_{c}") for i, c in enumerate(MEASURES)])


def hash_split(spark, folder):
    return split.with_split(table(spark, folder, "orders"), ["o_orderkey"]).select("o_orderkey", "part")


def _scored_events(spark, folder):
    return table(spark, folder, "events").select(
        F.expr(LABEL_SQL).cast("double").alias("label"),
        (F.col("value") / 500).alias("score"),
        (F.col("value") > 30).cast("double").alias("prediction"),
    )


def weighted_f1(spark, folder):
    scored = _scored_events(spark, folder)
    return evaluate.weighted_f1(scored, F.col("label"), F.col("prediction")).withColumn(
        "weighted_f1", F.round("weighted_f1", 10)
    )


def roc_curve(spark, folder):
    return evaluate.roc_curve(_scored_events(spark, folder), F.col("label"), F.col("score"))


def auc_score(spark, folder):
    auc = evaluate.auc_score(_scored_events(spark, folder), F.col("label"), F.col("score"))
    return auc.withColumn("auc", F.round("auc", 10))


def _metrics(spark, folder):
    band = F.concat(F.lit("band_"), (F.col("user_id") % 3).cast("string"))
    return (
        table(spark, folder, "events")
        .groupBy("event_type", band.alias("band"))
        .agg(F.round(F.avg("value"), 4).alias("mean_value"), F.count(F.lit(1)).alias("n"))
    )


def pivot_metric(spark, folder):
    return evaluate.pivot_metric(
        _metrics(spark, folder), "event_type", "band", ["band_0", "band_1", "band_2"], "mean_value"
    )


def best_model(spark, folder):
    return evaluate.best_model(_metrics(spark, folder), ["mean_value", "n"], ["event_type", "band"])


RAW_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("event_date", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("weekday", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("k", T.IntegerType()),
    ]
)
NUMERIC = ["value", "hour", "k", "k_minus_hour", "month"]
CATEGORICAL = ["event_type", "weekday"]
EVENT_TYPES = ["view", "signup", "error", "click", "purchase"]


def raw_events(spark, folder):
    """Events as they would arrive, some values missing, with the label kept aside."""
    return table(spark, folder, "events").select(
        "event_id",
        F.date_format("ts", "dd/MM/yyyy").alias("event_date"),
        F.expr("CASE WHEN event_id % 19 = 0 THEN 'unknown' ELSE event_type END").alias("event_type"),
        F.date_format("ts", "E").alias("weekday"),
        F.expr("CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END").alias("value"),
        F.hour("ts").alias("hour"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.expr(LABEL_SQL).cast("double").alias("label"),
    )


def prepare_events(df):
    """The shared features; an unknown event type becomes null and is imputed with the fitted mode."""
    return prepare_rows(df, "event_date", {"k_minus_hour": ("k", "hour")}, {"event_type": (EVENT_TYPES, None)})


def _split_events(spark, folder):
    return split.hash_split(prepare_events(raw_events(spark, folder)), ["event_id"])


def serving_model_fit(spark, folder):
    """Fit the feature model on training rows, save and load it, and encode every event."""
    train, _ = _split_events(spark, folder)
    path = scratch_path(spark, "features")
    features.fit_features(train, NUMERIC, CATEGORICAL).save(spark, path)
    loaded = features.FeatureModel.load(spark, path)
    encoded = loaded.transform(prepare_events(raw_events(spark, folder)))
    v = vector_to_array("scaled_features")
    # The vector holds the numbers, then one block per category with at most one part set.
    types = F.slice(v, len(NUMERIC) + 1, len(EVENT_TYPES) - 1)
    weekdays = F.slice(v, len(NUMERIC) + len(EVENT_TYPES), 6)
    return encoded.select(
        "event_id",
        *[F.round(v[i], 6).alias(f"scaled_{c}") for i, c in enumerate(NUMERIC)],
        F.round(F.array_max(types), 6).alias("scaled_type"),
        F.array_position(types, F.array_max(types)).alias("type_position"),
        F.round(F.array_max(weekdays), 6).alias("scaled_weekday"),
        F.array_position(weekdays, F.array_max(weekdays)).alias("weekday_position"),
    )


def large_index_model(spark, folder):
    """Fit, save and load a model whose category has as many values as there are customers, and encode the test orders.

    Orders of customers that training has not met are skipped.
    """
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    train, test = split.hash_split(orders, ["o_orderkey"])
    path = scratch_path(spark, "features")
    features.fit_features(train, ["o_totalprice"], ["o_orderpriority"], "index", large=["o_custkey"]).save(spark, path)
    encoded = features.FeatureModel.load(spark, path).transform(test)
    v = vector_to_array("scaled_features")
    names = ["scaled_totalprice", "scaled_orderpriority", "scaled_custkey"]
    return encoded.select("o_orderkey", "o_custkey_index", *[F.round(v[i], 6).alias(n) for i, n in enumerate(names)])


# What training does not see: one type, one weekday; and a column that is not imputed.
UNSEEN_SQL = "event_type = 'signup' OR weekday = 'Sun'"


def serving_skip_counts(spark, folder):
    """Score events with categories that training has not met and numbers that are missing: rows by cause, from one pass."""
    events = raw_events(spark, folder).withColumn("k", F.expr("CASE WHEN event_id % 17 <> 0 THEN k END"))
    events = prepare_events(events)
    train, _ = split.hash_split(events.where(f"NOT coalesce({UNSEEN_SQL}, FALSE)"), ["event_id"])
    fills = features.fit_fill_values(train, ["value"], [])
    model = features.fit_features(train, NUMERIC, CATEGORICAL, "onehot", fills)
    return model.skip_counts(materialise(model.transform_marked(events), "encoded"))


def model_compare(spark, folder):
    """Compare all models; per model the rows behind its metrics, and whether Spark's evaluators find the same ones."""
    train, test = _split_events(spark, folder)
    compared = models.model_compare(train, test, NUMERIC, CATEGORICAL, "label")
    n_train, n_test = train.count(), test.count()
    auc = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    f1 = MulticlassClassificationEvaluator(metricName="f1")
    rows = []
    for found in compared.results.collect():  # one row per model
        pair = found["encoding"], found["model"]
        scored = compared.scores.where((F.col("encoding") == pair[0]) & (F.col("model") == pair[1]))
        agree = [abs(e.evaluate(scored) - found[m]) < 1e-9 for e, m in ((auc, "roc_auc"), (f1, "f1_score"))]
        counts = scored.agg(F.count(F.lit(1)), F.count_if(F.col("label") == 1)).first()
        rows.append((*pair, n_train, *counts, n_test - counts[0], *agree))
    return spark.createDataFrame(
        rows,
        "encoding string, model string, train_rows long, test_rows long, test_positives long, skipped_rows long, "
        "auc_agrees boolean, f1_agrees boolean",
    )


def stream_score(spark, folder):
    """Fit on training events and save, then load and score all events as a stream of change messages.

    Returns message fields that scoring leaves alone, whether there is a prediction, and whether the batch gives the same.
    """
    train, _ = _split_events(spark, folder)
    saved, inbox, outbox, checkpoint = (scratch_path(spark, n) for n in ("models", "inbox", "outbox", "offsets"))
    fitted = features.fit_features(train, NUMERIC, CATEGORICAL)
    fitted.save(spark, f"{saved}/features")
    regression = models.classifiers()["Logistic Regression"]
    regression.fit(fitted.transform(train)).write().save(f"{saved}/model")

    messages = event_messages(raw_events(spark, folder))
    scorer = Scorer(
        RAW_SCHEMA,
        features.FeatureModel.load(spark, f"{saved}/features"),
        LogisticRegressionModel.load(f"{saved}/model"),
        prepare_events,
        ["event_id", "month"],
    )
    only_deletes = event_messages(raw_events(spark, folder).where("event_id % 47 = 0"))
    for arriving in (messages, only_deletes):  # the second batch leaves nothing to score
        arriving.write.mode("append").text(inbox)
        query = scorer.start(text_messages(spark, inbox), parquet_sink(outbox), checkpoint, available_now=True)
        query.awaitTermination()
    # Scored from the stored messages and stored: together with their making it is a plan that costs more than its data.
    batch = scorer.score(spark.read.text(inbox), counted=True).select("event_id", F.col("prediction").alias("_batch"))
    batch = materialise(batch, "batch-scores")
    same = F.coalesce(F.col("prediction") == F.col("_batch"), F.lit(False)).alias("agrees")
    predicted = F.col("prediction").isNotNull().alias("predicted")
    scored = read_scored(spark, outbox).join(batch, "event_id", "left")
    return scored.select("event_id", "event_date", "weekday", "hour", "k", predicted, same)


def event_messages(raw):
    """Every form of message: rows in all envelopes, deletes, and texts that are no JSON."""
    row = F.to_json(F.struct(*RAW_SCHEMA.fieldNames()))
    wrapped = lambda before, after: F.concat(F.lit(before), row, F.lit(after))
    form = F.col("event_id") % 4
    value = (
        F.when(F.col("event_id") % 47 == 0, wrapped('{"payload":{"before":', ',"after":null,"op":"d"}}'))
        .when(F.col("event_id") % 43 == 0, F.lit("no message"))
        .when(form == 0, wrapped('{"payload":', "}"))
        .when(form == 1, wrapped('{"after":', "}"))
        .when(form == 2, row)
        .otherwise(wrapped('{"payload":{"after":', ',"op":"c"}}'))
    )
    return raw.select(value.alias("value"))


QUERIES = {
    "string_index": string_index,
    "frequency_index": frequency_index,
    "one_hot": one_hot,
    "assemble_scale": assemble_scale,
    "hash_split": hash_split,
    "weighted_f1": weighted_f1,
    "roc_curve": roc_curve,
    "auc_score": auc_score,
    "pivot_metric": pivot_metric,
    "best_model": best_model,
    "serving_model_fit": serving_model_fit,
    "large_index_model": large_index_model,
    "serving_skip_counts": serving_skip_counts,
    "model_compare": model_compare,
    "stream_score": stream_score,
}


def _index_sql(column):
    return f"""(SELECT {column}, CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {column}) - 1 AS DOUBLE)
            AS {column}_index FROM events GROUP BY {column})"""


_SCORED_SQL = f"""scored AS (SELECT {LABEL_SQL} AS label, value / 500 AS score,
            CASE WHEN value > 30 THEN 1.0 ELSE 0.0 END AS prediction FROM events)"""
_STEPS_SQL = f"""{_SCORED_SQL},
        counts AS (SELECT score, COUNT(*) FILTER (WHERE label = 1) AS pos, COUNT(*) FILTER (WHERE label = 0) AS neg
            FROM scored GROUP BY score),
        steps AS (SELECT *, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp, SUM(pos) OVER () AS p, SUM(neg) OVER () AS n,
                ROW_NUMBER() OVER w AS i, LEAD(pos) OVER w AS next_pos, LEAD(neg) OVER w AS next_neg
            FROM counts WINDOW w AS (ORDER BY score DESC))"""
_METRICS_SQL = """metrics AS (SELECT event_type, 'band_' || CAST(user_id % 3 AS VARCHAR) AS band,
            ROUND(AVG(value), 4) AS mean_value, COUNT(*) AS n FROM events GROUP BY 1, 2)"""



def _block_sql(column):
    """CTE of the scaled one-hot part of each category: its position, and 1 / deviation."""
    return f"""{column}_block AS (
            SELECT {column}, i, CASE WHEN i < k THEN sqrt((n - 1) / (c * (1 - c / n))) ELSE 0 END AS v FROM (
                SELECT {column}, CAST(COUNT(*) AS DOUBLE) AS c, CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS n,
                    ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {column}) AS i, COUNT(*) OVER () AS k
                FROM train GROUP BY {column}))"""


_ENCODED_SQL = f"""
        WITH raw AS (SELECT event_id, CASE WHEN event_id % 19 <> 0 THEN event_type END AS event_type,
                strftime(ts, '%a') AS weekday, CASE WHEN event_id % 13 <> 0 THEN value END AS value,
                CAST(hour(ts) AS DOUBLE) AS hour, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
                CAST(month(ts) AS DOUBLE) AS month,
                CAST('0x' || substr(md5('42:' || CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 1000 < 700 AS in_train
            FROM events),
        fills AS (SELECT quantile_disc(value, 0.5) AS value, (SELECT event_type FROM raw WHERE in_train
                AND event_type IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, event_type LIMIT 1) AS event_type
            FROM raw WHERE in_train),
        filled AS (SELECT r.* REPLACE (COALESCE(r.value, f.value) AS value,
                COALESCE(r.event_type, f.event_type) AS event_type), k - hour AS k_minus_hour FROM raw r, fills f),
        train AS (SELECT * FROM filled WHERE in_train),
        s AS (SELECT {", ".join(f"STDDEV_SAMP({c}) AS s_{c}" for c in NUMERIC)} FROM train),
        {_block_sql("event_type")}, {_block_sql("weekday")}
        SELECT event_id, {", ".join(f"ROUND(CASE WHEN s_{c} > 0 THEN {c} / s_{c} ELSE 0 END, 6) AS scaled_{c}" for c in NUMERIC)},
            ROUND(t.v, 6) AS scaled_type, CASE WHEN t.v > 0 THEN t.i ELSE 1 END AS type_position,
            ROUND(w.v, 6) AS scaled_weekday, CASE WHEN w.v > 0 THEN w.i ELSE 1 END AS weekday_position
        FROM filled, s, event_type_block t, weekday_block w
        WHERE filled.event_type = t.event_type AND filled.weekday = w.weekday"""

_SPLIT_SQL = "CAST('0x' || substr(md5('42:' || CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 1000 < 700"

_ORDER_SPLIT_SQL = _SPLIT_SQL.replace("event_id", "o_orderkey")

ORACLES = {
    "serving_model_fit": _ENCODED_SQL,
    "large_index_model": f"""
        WITH o AS (SELECT *, {_ORDER_SPLIT_SQL} AS in_train FROM orders),
        {", ".join(f"""{c}_index AS (SELECT {c}, CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {c}) - 1 AS DOUBLE) AS i_{c}
            FROM o WHERE in_train GROUP BY {c})""" for c in ("o_custkey", "o_orderpriority"))},
        e AS (SELECT * FROM o JOIN o_custkey_index USING (o_custkey) JOIN o_orderpriority_index USING (o_orderpriority)),
        s AS (SELECT STDDEV_SAMP(o_totalprice) AS s1, STDDEV_SAMP(i_o_orderpriority) AS s2, STDDEV_SAMP(i_o_custkey) AS s3
            FROM e WHERE in_train)
        SELECT o_orderkey, i_o_custkey AS o_custkey_index, ROUND(o_totalprice / s1, 6) AS scaled_totalprice,
            ROUND(i_o_orderpriority / s2, 6) AS scaled_orderpriority, ROUND(i_o_custkey / s3, 6) AS scaled_custkey
        FROM e, s WHERE NOT in_train""",
    "serving_skip_counts": f"""
        WITH e AS (SELECT event_id, CASE WHEN event_id % 19 <> 0 THEN event_type END AS event_type, strftime(ts, '%a') AS weekday,
                CASE WHEN event_id % 17 <> 0 THEN json_extract_string(props, '$.k') END AS k FROM events),
        f AS (SELECT *, event_type IS NULL AS no_type, event_type = 'signup' AS new_type, weekday = 'Sun' AS new_day,
            k IS NULL AS no_k FROM e)
        SELECT unnest(['given', 'kept', 'unseen event_type', 'missing event_type', 'unseen weekday', 'missing weekday',
                'missing value', 'missing hour', 'missing k', 'missing k_minus_hour', 'missing month']) AS cause,
            unnest([COUNT(*), COUNT(*) FILTER (WHERE NOT no_type AND NOT new_type AND NOT new_day AND NOT no_k),
                COUNT(*) FILTER (WHERE new_type), COUNT(*) FILTER (WHERE no_type), COUNT(*) FILTER (WHERE new_day), 0, 0, 0,
                COUNT(*) FILTER (WHERE no_k), COUNT(*) FILTER (WHERE no_k), 0]) AS n FROM f""",
    "model_compare": f"""
        WITH e AS (SELECT {_SPLIT_SQL} AS in_train, {LABEL_SQL} AS label FROM events),
        c AS (SELECT COUNT(*) FILTER (WHERE in_train) AS train_rows, COUNT(*) FILTER (WHERE NOT in_train) AS test_rows,
            COUNT(*) FILTER (WHERE NOT in_train AND label = 1) AS test_positives FROM e)
        SELECT encoding, model, train_rows, test_rows, test_positives, CAST(0 AS BIGINT) AS skipped_rows,
            TRUE AS auc_agrees, TRUE AS f1_agrees
        FROM c, (VALUES ('index'), ('onehot')) a(encoding), (VALUES ('Logistic Regression'), ('Decision Tree'), ('Random Forest')) b(model)""",
    "stream_score": """
        SELECT event_id, strftime(ts, '%d/%m/%Y') AS event_date, strftime(ts, '%a') AS weekday,
            CAST(hour(ts) AS INTEGER) AS hour, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
            TRUE AS predicted, TRUE AS agrees
        FROM events WHERE event_id % 47 <> 0 AND event_id % 43 <> 0""",
    "frequency_index": """
        SELECT o_orderkey, o_custkey, o_custkey_index FROM orders JOIN (SELECT o_custkey,
            CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, o_custkey) - 1 AS DOUBLE) AS o_custkey_index
            FROM orders GROUP BY o_custkey) USING (o_custkey)""",
    "string_index": f"""
        SELECT event_id, event_type, props, event_type_index, props_index FROM events
        JOIN {_index_sql("event_type")} USING (event_type) JOIN {_index_sql("props")} USING (props)""",
    "one_hot": f"""
        WITH idx AS {_index_sql("event_type")},
        hot AS (SELECT a.event_type, string_agg(CASE WHEN a.event_type = b.event_type THEN '1' ELSE '0' END, ','
                ORDER BY b.event_type_index) AS one_hot
            FROM idx a JOIN idx b ON b.event_type_index < (SELECT MAX(event_type_index) FROM idx) GROUP BY a.event_type)
        SELECT event_id, event_type, one_hot FROM events JOIN hot USING (event_type)""",
    "assemble_scale": f"""
        WITH s AS (SELECT {", ".join(f"STDDEV_SAMP({c}) AS s_{c}" for c in MEASURES)} FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
            {", ".join(f"ROUND({c} / s_{c}, 6) AS scaled_{c}" for c in MEASURES)} FROM lineitem, s""",
    "hash_split": """
        SELECT o_orderkey, CASE WHEN CAST('0x' || substr(md5('42:' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT)
            % 1000 < 700 THEN 'train' ELSE 'test' END AS part FROM orders""",
    "weighted_f1": f"""
        WITH {_SCORED_SQL}, classes AS (SELECT DISTINCT label AS c FROM scored)
        SELECT ROUND(SUM(actual * 2.0 * tp / (actual + predicted)) / SUM(actual), 10) AS weighted_f1,
            CAST(SUM(actual) AS BIGINT) AS n
        FROM (SELECT c, CAST(COUNT(*) FILTER (WHERE label = c) AS DOUBLE) AS actual,
                CAST(COUNT(*) FILTER (WHERE prediction = c) AS DOUBLE) AS predicted,
                CAST(COUNT(*) FILTER (WHERE label = c AND prediction = c) AS DOUBLE) AS tp
            FROM scored, classes GROUP BY c)""",
    "roc_curve": f"""
        WITH {_STEPS_SQL}
        SELECT score, CAST(fp AS DOUBLE) / CAST(n AS DOUBLE) AS fpr, CAST(tp AS DOUBLE) / CAST(p AS DOUBLE) AS tpr,
            i = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg AS corner FROM steps
        UNION ALL SELECT NULL, 0.0, 0.0, TRUE""",
    "auc_score": f"""
        WITH {_STEPS_SQL}
        SELECT ROUND(SUM(CAST(neg AS DOUBLE) * (CAST(tp AS DOUBLE) - CAST(pos AS DOUBLE) / 2))
                / (CAST(MAX(p) AS DOUBLE) * CAST(MAX(n) AS DOUBLE)), 10) AS auc,
            CAST(MAX(p) AS BIGINT) AS positives, CAST(MAX(n) AS BIGINT) AS negatives FROM steps""",
    "pivot_metric": f"""
        WITH {_METRICS_SQL} SELECT event_type, MAX(mean_value) FILTER (WHERE band = 'band_0') AS band_0,
            MAX(mean_value) FILTER (WHERE band = 'band_1') AS band_1,
            MAX(mean_value) FILTER (WHERE band = 'band_2') AS band_2 FROM metrics GROUP BY event_type""",
    "best_model": f"""
        WITH {_METRICS_SQL} SELECT * FROM metrics ORDER BY mean_value DESC, n DESC, event_type, band LIMIT 1""",
}
