"""The queries of this package: each applies one operator to its whole table and returns the agreed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import ann, decontam, fim, katz, langid, ranked, toxicity, url_filter, warc
from tidewheel.llm.neardup import near_duplicates
from tidewheel.llm.packing import pack
from tidewheel.llm.secret_scan import secret_digests
from tidewheel.llm.substring import repeat_digests


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(_table(spark, folder, "pages"), url_filter.RULES)


def archive_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    return warc.record_digests(_table(spark, folder, "pages"))


def nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def language_labels(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = langid.identify(docs, langid.fit(docs))
    return found.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeat_digests(_table(spark, folder, "documents"))


def benchmark_contamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def backoff_scores(spark: SparkSession, folder: str) -> DataFrame:
    return katz.score_documents(_table(spark, folder, "documents"), katz.held_out("doc_id"))


def secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    return secret_digests(_table(spark, folder, "documents"))


def near_duplicate_classes(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"), shingle=4, percent=80)


def packed_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return pack(_table(spark, folder, "documents"))


def toxic_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    scored = toxicity.score_toxicity(docs, toxicity.fit(docs, _table(spark, folder, "labels")))
    return scored.select(
        "doc_id",
        langid.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.size("clauses").alias("n_clauses"),
    )


def fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fim.digests(_table(spark, folder, "documents"))


def ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), k=10)


QUERIES = {
    "op1_url_verdicts": url_verdicts,
    "op2_warc_derivatives": archive_derivatives,
    "op3_recurrent_language_id": language_labels,
    "op4_nearest_vectors": nearest_vectors,
    "op5_repeated_passages": repeated_passages,
    "op6_benchmark_contamination": benchmark_contamination,
    "op7_katz_backoff_scores": backoff_scores,
    "op8_secret_scan": secret_spans,
    "op9_minhash_near_dedup": near_duplicate_classes,
    "op10_cost_balanced_packing": packed_sequences,
    "op11_toxicity_grammar": toxic_documents,
    "op12_fill_in_middle": fill_in_middle,
    "op13_ranked_search": ranked_search,
}

ORACLES = {
    "op1_url_verdicts": url_filter.oracle(url_filter.RULES),
    "op2_warc_derivatives": warc.oracle(),
    "op6_benchmark_contamination": decontam.ORACLE,
    "op12_fill_in_middle": fim.ORACLE,
    "op13_ranked_search": ranked.ORACLE,
}
