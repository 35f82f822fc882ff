"""From raw documents to packed training sequences: five stages, each one operator of ``tidewheel.llm``.

``STAGES`` lists them in order. Each takes the session, the documents its predecessor kept
and the folder of the other tables. All but the last return the columns of documents, whatever
they are, and decide about every row, also those with null or repeated ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import langid
from tidewheel.llm.decontam import contamination
from tidewheel.llm.joins import store
from tidewheel.llm.neardup import near_duplicates
from tidewheel.llm.packing import pack
from tidewheel.llm.secret_scan import redact_texts

MIN_LANGUAGE_SCORE = 0.3


def _key() -> Column:
    """A row's name in a join: its id, or a digest of its text if it has none."""
    text = F.concat(F.lit("text "), F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    return F.coalesce(F.col("doc_id").cast("string"), text)


def language_id(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drop documents without a language: no letters, or no label with a mean probability of MIN_LANGUAGE_SCORE.

    The network learns from the labelled rows of ``docs``. If there are none, only letterless texts go.
    """
    model = langid.fit(docs)
    return langid.keep_identified(docs, model, MIN_LANGUAGE_SCORE)


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep one document of each near-duplicate class, that with the smallest id; rows without an id stay.

    Where ids repeat, rows are compared one by one: a row goes for its own text only, never for its id.
    """
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if store(repeated, "repeated").isEmpty():
        gone = near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
        return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    row = _unused(docs, "_row")
    numbered = store(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    classes = near_duplicates(numbered.where("doc_id IS NOT NULL"), doc_id=row).select(F.col("doc_id").alias(row), "component_id")
    ids = numbered.select(row, F.col("doc_id").alias("_id"))
    first = classes.join(ids, row).groupBy("component_id").agg(F.min(F.struct("_id", row)).alias("_first"))
    kept = numbered.join(first.select(F.col("_first")[row].alias(row)), row, "left_semi")
    return kept.select(docs.columns).unionAll(numbered.where("doc_id IS NULL").select(docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    key = _unused(docs, "_key")
    named = docs.select(_key().alias("doc_id"), "text")
    hit = contamination(named, items).where("contaminated").select(F.col("doc_id").alias(key)).distinct()
    return docs.withColumn(key, _key()).join(hit, key, "left_anti").select(docs.columns)


def hide_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Replace every secret in the texts by the name of its kind and correct ``n_chars``; no document goes."""
    return redact_texts(docs, "text", "n_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Lay out all documents as pieces of token sequences."""
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("hide_secrets", hide_secrets),
    ("pack_sequences", pack_sequences),
]

# A trained network, signature joins and a tokenizer are not SQL: the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Apply all stages to the documents table; the rows between two stages are stored."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
