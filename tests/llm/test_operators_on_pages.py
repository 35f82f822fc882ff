"""Url verdicts, archive derivatives and graph search on small tables."""

import gzip
import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewheel.llm import ann, url_filter, warc

PAGES = "page_id long, url string, html string, host string, name string, rest string, hit string"
LINK = '<html><head><link rel="canonical" href="{}"></head></html>'
REFRESH = "<meta http-equiv='refresh' content='0; url={}'>"


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "h", "n", "r", "x") for r in rows], PAGES)


RULES = [("ok.net/", "allow"), ("bad.com/", "block"), ("bad.com/good/", "allow"), ("sub.bad.com/good/worse", "block")]


def test_longest_rule_decides_and_blocks_reach_aliases(spark):
    rows = [
        (1, "http://BAD.com/x?q#f", None),
        (2, "https://www.bad.com/good/y", ""),
        (3, "https://sub.bad.com/good/worse1", None),
        (4, "http://notbad.com/", LINK.format("http://bad.com/x?q")),  # alias of 1
        (5, "http://far.org/a", REFRESH.format("//notbad.com/")),  # alias of 4
        (6, "http://ok.net/b", LINK.format("http://far.org/a")),  # allowed itself: the component is mixed
        (7, "http://lone.org/p/q", LINK.format("r")),  # points at lone.org/p/r
        (8, "http://lone.org/p/r#top", LINK.format("/s")),
        (9, "http://lone.org/s", LINK.format("http://bad.com/z")),
        (10, None, LINK.format("http://bad.com/z")),
        (11, "no scheme", None),
        (12, "x://", None),
        (12, "x://", None),
        (13, "http://bad.com.org/", None),
    ]
    got = [(r["page_id"], r["host"], r["rule"], r["verdict"], r["via_alias"]) for r in url_filter.judge(_pages(spark, rows), RULES).collect()]
    assert sorted(got) == [
        (1, "bad.com", "bad.com/", "block", False),
        (2, "www.bad.com", "bad.com/good/", "allow", False),
        (3, "sub.bad.com", "sub.bad.com/good/worse", "block", False),
        (4, "notbad.com", None, "allow", False),
        (5, "far.org", None, "allow", False),
        (6, "ok.net", "ok.net/", "allow", False),
        (7, "lone.org", None, "block", True),
        (8, "lone.org", None, "block", True),
        (9, "lone.org", None, "block", True),
        (10, "", None, "allow", False),
        (11, "", None, "allow", False),
        (12, "", None, "allow", False),
        (12, "", None, "allow", False),
        (13, "bad.com.org", None, "allow", False),
    ]


def test_targets_are_resolved_and_every_link_counts(spark, tmp_path):
    """Each even page is blocked through a link to the page before it; Spark and DuckDB agree on all of them."""
    many = LINK.format("http://a.com/none") + LINK.format("/none2") + REFRESH.format("http://a.com/none3")
    rows = [
        (1, "http://example.org/es/", None),
        (2, "http://e2.net", LINK.format("http://example.org/es/")),
        (4, "http://e4.net/x", LINK.format("http://e2.net/")),  # an empty path is /
        (6, "http://e6.net/p?a=1", LINK.format("http://example.org/es/?v=1")),
        (7, "http://e6.net/q", LINK.format("p?a=1&amp;b=2")),
        (8, "http://e6.net/p", LINK.format("?a=1")),
        (10, "http://e6.net/d/e/f", LINK.format("../../p")),
        (12, "http://e6.net/d/e/", LINK.format("./../../d/./e/f")),
        (14, "http://e6.net/up", many + LINK.format("http://example.org/es/") + many),
        (15, "http://e6.net/share", LINK.format("/go?to=http://example.org/es/")),  # a url in the query is no target
        (16, "http://e7.net/a/..", LINK.format("HTTP://EXAMPLE.ORG/es/#top")),
        (18, "http://e8.net/", LINK.format("http://e7.net")),
        (19, "http://e9.net/", LINK.format("#top") + LINK.format("")),
        (21, "http://e6.net/p%", LINK.format("../../../..")),  # above the top is the top
        (23, None, many),
        (25, "", many),
    ]
    pages = _pages(spark, rows).select("page_id", "url", "html")
    judged = url_filter.judge(pages, url_filter.RULES)
    verdicts = {r["page_id"]: r["verdict"] for r in judged.collect()}
    assert {i for i, v in verdicts.items() if v == "block"} == {1, *(i for i, *_ in rows if i % 2 == 0)}
    pages.write.parquet(f"{tmp_path}/pages")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages/*.parquet')")
    found = con.execute(url_filter.oracle(url_filter.RULES))
    names = [c[0] for c in found.description]
    assert sorted(found.fetchall()) == sorted(tuple(r) for r in judged.select(*names).collect())


def test_redirect_table_adds_edges_and_nothing_is_judged(spark):
    pages = _pages(spark, [(1, "http://a.org/1", None), (2, "http://b.org/2", None)])
    moved = spark.createDataFrame([("http://a.org/1", "http://bad.com/1"), (None, "http://b.org/2")], "source string, target string")
    verdicts = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, RULES, redirects=moved).collect()}
    assert verdicts == {1: "block", 2: "allow"}
    assert url_filter.judge(pages.limit(0), RULES).collect() == []
    assert {r["verdict"] for r in url_filter.judge(pages, []).collect()} == {"allow"}


HTML = """<html lang="fr"><head><title>A
title</title><style>p{}</style></head><body><!-- gone --><p>One &amp; <b>two</b></p>
<script>var t="</p>";</script><ul><li>x</li><li>y &lt;z&gt;</li></ul></body></html>"""


def test_derived_records_are_linked_and_keep_headers_and_digests(spark):
    pages = spark.createDataFrame([(1, "http://a/é", HTML), (2, None, None), (2, None, None)], "page_id long, url string, html string")
    source = warc.responses(pages)
    rows = warc.derive(source, "page_id").collect()
    assert len(rows) == 6
    response = source.where("page_id = 1").first()
    for r in (r for r in rows if r["page_id"] == 1):
        assert r["refers_to"] == response["record_id"] and r["target_uri"] == "http://a/é"
        assert r["source_digest"] == "sha1:" + hashlib.sha1(HTML.encode()).hexdigest()
        assert r["block_digest"] == "sha1:" + hashlib.sha1(r["block"].encode()).hexdigest()
        assert r["content_length"] == len(r["block"].encode()) and "text/html" in r["source_headers"]
    block = {r["record_type"]: r["block"] for r in rows if r["page_id"] == 1}
    assert block["conversion"] == "One & two\nx\ny <z>"
    assert "http-Content-Type: text/html" in block["metadata"] and "title: A title\r\nlanguage: fr" in block["metadata"]
    assert {r["block"] for r in rows if r["page_id"] == 2 and r["record_type"] == "conversion"} == {""}
    assert warc.derive(source.limit(0)).collect() == []


def test_all_entities_are_decoded_once(spark):
    html = "<p>a&middot;b caf&eacute; &#x2014;&#8212;&#39;&apos; x&nbsp;&#160;&#xA0;y</p><p>&amp;lt; &copy 1 &lt;i&gt; &nosuch; & &#xD800;&#0;</p>"
    pages = spark.createDataFrame([(1, "u", html), (2, "u", None)], "page_id long, url string, html string")
    rows = warc.derive(warc.responses(pages), "page_id").where("record_type = 'conversion'").collect()
    block = {r["page_id"]: r["block"] for r in rows}
    assert block == {1: "a·b café ——'' x y\n&lt; © 1 <i> &nosuch; & \ufffd\ufffd", 2: ""}
    for r in rows:
        assert r["block_digest"] == "sha1:" + hashlib.sha1(r["block"].encode()).hexdigest()
        assert r["content_length"] == len(r["block"].encode())


def test_archives_are_read_and_written(spark, tmp_path):
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\n\r\n<p>caf\xe9</p>".encode("latin-1")
    head = "WARC/1.0\r\nWARC-Type: {}\r\nWARC-Record-ID: <urn:uuid:{}>\r\nWARC-Target-URI: http://x/\r\nContent-Length: {}\r\n\r\n"
    records = [(head.format(kind, n, len(http)).encode() + http + b"\r\n\r\n") for n, kind in enumerate(("request", "response"))]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "b.warc").write_bytes(b"".join(records))
    found = warc.read_responses(spark, str(tmp_path))
    assert [(r["record_id"], r["payload"]) for r in found.collect()] == [("<urn:uuid:1>", "<p>café</p>")] * 2
    derived = warc.derive(found)
    members = b"".join(bytes(r["member"]) for r in warc.serialise(derived).collect())
    again = list(warc.parse_records(members))
    assert sorted(h["warc-type"] for h, _ in again) == ["conversion"] * 2 + ["metadata"] * 2
    assert {b.decode() for h, b in again if h["warc-type"] == "conversion"} == {"café"}
    assert {h["warc-refers-to"] for h, _ in again} == {"<urn:uuid:1>"}


def _exact(vectors, ids, queries, k):
    out = {}
    for q in queries:
        score = np.array([float(np.dot(v.astype(np.float64), vectors[q].astype(np.float64))) for v in vectors])
        order = sorted((i for i in range(len(ids)) if ids[i] != ids[q]), key=lambda i: (-score[i], ids[i]))[:k]
        out[ids[q]] = [(ids[i], score[i]) for i in order]
    return out


def test_search_finds_the_largest_inner_products(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(900, 24)) * rng.uniform(0.5, 2, (900, 1))).astype(np.float32)
    vectors[300:420] = vectors[300]  # many copies of one vector
    rows = [(int(i), v.tolist(), 1, "x", 2) for i, v in enumerate(vectors)]
    odd = [(2000, None), (2020, [0.0] * 24), (2040, [float("nan")] + [1.0] * 23), (2060, [None] + [1.0] * 23), (2080, [1.0]),
           (None, [1.0] * 24), (2100, [float("inf")] + [1.0] * 23), (2120, [])]
    table = spark.createDataFrame([*rows, *[(i, v, 0, "y", 3) for i, v in odd], rows[40]], "vec_id long, embedding array<float>, g int, shard string, score int")
    found = ann.nearest(table.repartition(4), F.col("vec_id") % 20 == 0, k=20, shard_rows=300).collect()
    want = _exact(vectors, list(range(900)), range(0, 900, 20), 20)
    lists = {}
    for r in found:
        lists.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(lists) == set(want)
    hits = 0
    for q, got in lists.items():
        got.sort()
        assert [g[0] for g in got] == list(range(1, 21))
        assert [(-s, v) for _, v, s in got] == sorted((-s, v) for _, v, s in got)
        for _, v, s in got:
            assert s == pytest.approx(float(vectors[q].astype(np.float64) @ vectors[v].astype(np.float64)), abs=1e-9)
        hits += len({v for _, v, _ in got} & {v for v, _ in want[q]})
    assert hits / (20 * len(want)) >= 0.9
    copies = [v for _, v, _ in lists[300]]
    assert copies == [301 + i for i in range(20)] or vectors[300] @ vectors[copies[0]] > vectors[300] @ vectors[300]


def test_search_in_few_or_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(few, F.col("vec_id") % 20 == 0, k=5).collect())
    assert got == [(0, 1, 1, 0.5), (0, 2, 20, 0.0), (20, 1, 1, 0.5), (20, 2, 0, 0.0)]
    assert ann.nearest(few.limit(0), F.lit(True)).collect() == []
    assert ann.nearest(few, F.lit(False)).collect() == []
    assert ann.nearest(few.where("vec_id = 0"), F.lit(True)).collect() == []


def test_pruning_keeps_edges_in_different_directions():
    points = np.array([[0, 0], [1, 0], [1.1, 0.01], [0, 1.2]])
    points = np.concatenate([points, np.sqrt(4 - (points**2).sum(axis=1))[:, None]], axis=1)
    kept = ann.robust_prune(points, np.array([0]), np.array([[1, 2, 3, 0, 1, -1]]), 3, 1.2)
    assert kept[0].tolist() == [1, 3, -1]
