"""Fill-in-middle against a plain version, on awkward, very long and empty tables."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from brute import sha256
from fixtures import NAMELESS, REPEATED, SCHEMA, awkward, documents
from tidewheel.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def cut(doc_id, text):
    """(n, form, prefix, middle, suffix) of one document."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, None
    form = "spm" if h4 % 100 < 80 else "psm"
    return n, form, "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])


def expected(doc_id, text):
    n, form, p, m, s = cut(doc_id, text)
    if form == "plain":
        return doc_id, n, form, None, None, text or ""
    out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, form, len(p), len(m), out


@pytest.fixture(scope="module")
def texts():
    marks = {200 + i: t for i, t in enumerate(["<P>", "a <S> b", "x<M", "<", ">", "P>", "<P <S <M", "<<P", "S> <", "$1 \\ \\1 ${x}"] * 12)}
    odd = {400 + i: t for i, t in enumerate(["é 𝒳 ß y", "\n\n a\r\n", "a\x00b c", "\x1c\x85", "tail \t\n", " x"] * 10)}
    return awkward() | marks | odd


def test_cuts_match_a_plain_version(spark, texts):
    rows = fim.fill_in_middle(documents(spark, texts, REPEATED + NAMELESS)).withColumn("back", fim.restored()).collect()
    got = sorted((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in rows if r["doc_id"] is not None)
    assert got == sorted(expected(i, t) for i, t in [*texts.items(), (3, "again"), (3, "again")])
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}
    assert all(r["back"] == r["text"] for r in rows)
    nameless = sorted((r["n"], r["output"]) for r in rows if r["doc_id"] is None)
    assert nameless == sorted((e[1], e[5]) for e in (expected(None, "no id at all"), expected(None, None)))


def test_very_long_texts_need_no_stack(spark):
    texts = {1: "ab \n" * 400_000, 5: "x" * 3_000_000, 6: " " * 1_000_000 + "y", 8: "é𝒳 " * 300_000}
    texts |= {i: t for i, t in zip(range(20, 40), [*texts.values()] * 5)}
    rows = fim.fill_in_middle(documents(spark, texts)).withColumn("same", fim.restored() == F.col("text")).collect()
    assert all(r["same"] for r in rows) and {r["form"] for r in rows} >= {"plain", "spm"}
    for r in rows:
        assert tuple(r[c] for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")) == expected(r["doc_id"], texts[r["doc_id"]])


def test_digests_empty_tables_and_other_marks(spark, texts):
    docs = documents(spark, {i: texts[i] for i in range(40)})
    for r in fim.digests(docs).collect():
        assert r["restored_sha256"] == sha256(texts[r["doc_id"]])
        assert r["output_sha256"] == sha256(expected(r["doc_id"], texts[r["doc_id"]])[5])
    assert fim.digests(spark.createDataFrame([], SCHEMA)).collect() == []
    marks = fim.Sentinels("<pre$1>", "<suf\\>", "<mid>")
    for r in fim.fill_in_middle(docs, rate=100, spm_rate=0, marks=marks).withColumn("back", fim.restored(marks)).collect():
        assert r["form"] == "psm" and r["back"] == r["text"] and r["output"].startswith("<pre$1>")


def test_text_is_matched_once(spark, texts):
    """One counting and one replacing match a row; the digests do not run them again."""
    plan = fim.digests(documents(spark, {1: "a"}))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1 and plan.count("regexp_extract_all") <= 1
