"""The five stages against plain versions, each on what its predecessor kept."""

import collections

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline as pipeline
from fixtures import NAMELESS, documents
from tidewheel.llm import secret_scan
from tidewheel.llm.decontam import words as index_words
from tidewheel.llm.joins import store


@pytest.fixture(scope="module")
def kept(spark, folder):
    """Rows after each stage, by name."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    extra = [(5000, " 12 34 "), (5001, None), (5002, "password=Xy7Qw9Zz1 " + "the of and that in to was " * 30)]
    docs = docs.unionByName(
        spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in extra], docs.schema)
    )
    out = {"input": docs}
    for name, stage in pipeline.STAGES:
        docs = out[name] = store(stage(spark, docs, folder), name)
    return out


def test_stages_have_their_order_and_columns(kept):
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "decontaminate", "hide_secrets", "pack_sequences"]
    for name in names[:-1]:
        assert kept[name].columns == kept["input"].columns


def _ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_texts_without_a_language_go_and_clean_ones_stay(kept):
    gone = _ids(kept["input"]) - _ids(kept["language_id"])
    assert {5000, 5001} <= gone and len(gone) <= 2 + 0.01 * kept["input"].count()


def test_one_document_of_each_class_stays(kept):
    texts = {r["doc_id"]: r["text"] for r in kept["language_id"].collect()}
    want = {c for _, c in brute.near_classes(texts, 5).values()}
    assert _ids(kept["near_dedup"]) == want and len(want) < len(texts)


def test_documents_with_benchmark_windows_go(spark, kept, folder):
    items = spark.read.parquet(f"{folder}/benchmark.parquet").select(index_words(F.col("text")).alias("w")).collect()
    grams = {tuple(r["w"][k : k + 10]) for r in items for k in range(max(1, len(r["w"]) - 9))}
    dirty = set()
    for r in kept["near_dedup"].select("doc_id", index_words(F.col("text")).alias("w")).collect():
        if any(tuple(r["w"][k : k + 10]) in grams for k in range(len(r["w"]))):
            dirty.add(r["doc_id"])
    assert _ids(kept["decontaminate"]) == _ids(kept["near_dedup"]) - dirty


def test_secrets_are_hidden_and_nothing_else_changes(kept):
    before = {r["doc_id"]: r for r in kept["decontaminate"].collect()}
    after = {r["doc_id"]: r for r in kept["hide_secrets"].collect()}
    assert before.keys() == after.keys()
    letters = secret_scan.fit_letters(kept["decontaminate"])
    for i, r in after.items():
        assert r["text"] == secret_scan.redact(before[i]["text"], letters=letters) and r["n_chars"] == len(r["text"])
        assert not secret_scan.scan(r["text"], letters=letters)


def test_all_tokens_of_the_last_documents_are_packed(kept):
    length = collections.Counter()
    tokens = {}
    for r in kept["pack_sequences"].collect():
        length[r["doc_id"]] += r["length"]
        tokens[r["doc_id"]] = r["doc_tokens"]
    assert length == tokens and length.keys() == _ids(kept["hide_secrets"])


def test_columns_of_the_caller_stay_as_they_are(spark, folder):
    """Names that a join would like to use belong to the caller."""
    text = "the of and that in to was " * 9
    schema = "doc_id long, text string, lang string, _key long, _key_ string, row long, component_id long, _row string"
    docs = spark.createDataFrame([(1, text, "en", 7, "k", 8, 9, "r"), (2, "of in and " * 40, "en", 17, "l", 18, 19, "s")], schema)
    for name, stage in pipeline.STAGES[:-1]:
        docs = store(stage(spark, docs, folder), name)
        assert docs.columns == [c.split()[0] for c in schema.split(", ")]
    assert sorted(tuple(r)[3:] for r in docs.collect()) == [(7, "k", 8, 9, "r"), (17, "l", 18, 19, "s")]


def test_repeated_ids_lose_no_unrelated_text(spark, folder):
    a, b = ("".join(f"{p}{i} " for i in range(60)) for p in "ab")
    rows = [(5, a), (5, b), (5, a), (6, b + "end"), (7, "".join(f"c{i} " for i in range(60))), (None, a), (None, a), (5, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _row string")
    left = [tuple(r)[:2] for r in pipeline.near_dedup(spark, docs, folder).collect()]
    # Of a and its copy one stays, of b and its near copy the one with the smaller id; texts without words are no copies.
    assert sorted(left, key=repr) == sorted([(5, a), (5, b), (7, rows[4][1]), (None, a), (None, a), (5, None), (5, "")], key=repr)


def test_rows_without_ids_and_empty_tables_pass_every_stage(spark, folder):
    rows = documents(spark, {1: "the of and that in to was " * 9, 2: None}, NAMELESS + [(1, "the of and that in to was " * 9, *[None] * 7)])
    for docs in (rows, rows.limit(0)):
        for name, stage in pipeline.STAGES:
            docs = store(stage(spark, docs, folder), name)
        found = docs.collect()
        assert sorted(str(r["doc_id"]) for r in found) in (["1", "None"], [])
