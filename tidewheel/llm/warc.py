"""Derivatives of web archive responses: linked metadata and plain-text conversion records.

Every response yields two records. Both refer to the response by its identifier and carry
its uri, date and payload digest; the metadata record repeats the response's HTTP headers
as fields, the conversion record holds the text of the page. Identifiers and digests are
functions of the content, so a repeated run gives the same records.
"""

from __future__ import annotations

import gzip
import html as markup
import io
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LINE = "\r\n"

# Steps from HTML to text, read alike by Spark and DuckDB: pattern, replacement. The entities are those of the SQL twin.
_STEPS = [
    ("(?s)<!--.*?-->", " "),
    ("(?is)<(script|style|noscript|template)[^a-z].*?</(script|style|noscript|template) *>", " "),
    ("(?is)<head[^a-z].*?</head *>", " "),
    ("(?i)</?(p|div|br|li|ul|ol|h[1-6]|tr|td|th|table|article|section|nav|footer|header)([^a-z>][^>]*)?>", "\n"),
    ("(?s)<[^>]*>", ""),
]
_ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"),
             ("&amp;", "&")]
_TIDY = [("[ \t\r]+", " "), (" ?\n[ \n]*", "\n"), ("^[ \n]+", ""), ("[ \n]+$", "")]


def page_text(html: Column) -> Column:
    """Visible text of a page: one line per block element, blanks collapsed; null html gives empty text.

    Entities are decoded by the rules of HTML5, named and numeric ones, each once; a no-break space is a blank.
    """

    @F.arrow_udf("string")
    def decoded(texts: pa.Array) -> pa.Array:
        return pa.array([_decoded(t) for t in texts.to_pylist()], pa.string())

    return _tidy(decoded(_untagged(html)))


def listed_text(html: Column) -> Column:
    """``page_text`` as far as the SQL twin of the query goes: of all entities only those in ``_ENTITIES`` are decoded."""
    out = _untagged(html)
    for entity, to in _ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(to))
    return _tidy(out)


def _decoded(text: str) -> str:
    return _ENTITY.sub(lambda m: markup.unescape(m[0]).replace("\xa0", " "), text) if "&" in text else text


_ENTITY = re.compile("&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)")  # what html.unescape looks at


def _untagged(html: Column) -> Column:
    out = F.coalesce(html.cast("string"), F.lit(""))
    for pattern, to in _STEPS:
        out = F.regexp_replace(out, pattern, to)
    return out


def _tidy(text: Column) -> Column:
    for pattern, to in _TIDY:
        text = F.regexp_replace(text, pattern, to)
    return text


def _identifier(*parts: Column) -> Column:
    digest = F.md5(F.concat_ws("|", *parts))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(digest, a, n) for a, n in cuts]), F.lit(">"))


def _digest(block: Column) -> Column:
    return F.concat(F.lit("sha1:"), F.sha1(F.encode(block, "UTF-8")))


def responses(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = "1970-01-01T00:00:00Z"
) -> DataFrame:
    """Response records of stored pages: ``record_id, target_uri, date, http_headers, payload``."""
    body = F.coalesce(F.col(html).cast("string"), F.lit(""))
    length = F.octet_length(F.encode(body, "UTF-8")).cast("string")
    headers = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_LINE}Content-Type: text/html; charset=utf-8{_LINE}Content-Length: "),
        length,
        F.lit(_LINE),
    )
    key = F.coalesce(F.col(page_id).cast("string"), F.lit(""))
    return pages.select(
        F.col(page_id).alias("page_id"),
        _identifier(F.lit("response"), key, F.coalesce(F.col(url), F.lit("")), F.md5(body)).alias("record_id"),
        F.coalesce(F.col(url), F.lit("")).alias("target_uri"),
        F.lit(date).alias("date"),
        headers.alias("http_headers"),
        body.alias("payload"),
    )


def derive(records: DataFrame, *keep: str, to_text: Callable[[Column], Column] = page_text) -> DataFrame:
    """Two records for each response, one row each.

    Input columns are those of ``responses``; ``keep`` names more to carry along, ``to_text`` makes text of a payload. Output:
    ``record_type`` (metadata or conversion), ``record_id``, ``refers_to``, ``target_uri``,
    ``date``, ``content_type``, ``source_headers``, ``source_digest``, ``block``,
    ``block_digest`` and ``content_length``. Null fields count as empty, an empty payload gives an empty
    text record; repeated responses give repeated records. Nothing is shuffled.
    """
    source = records.select(
        *keep,
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("record_id", "target_uri", "date", "http_headers", "payload")],
    )
    title = F.regexp_extract("payload", "(?is)<title[^>]*>(.*?)</title *>", 1)
    language = F.regexp_extract("payload", '(?i)<html[^>]* lang *= *"?([a-z-]+)', 1)
    digest = _digest(F.col("payload"))
    fields = F.concat(
        F.regexp_replace("http_headers", "(?m)^([A-Za-z-]+):", "http-$1:"),
        F.lit("title: "), F.regexp_replace(title, "[\r\n]+", " "), F.lit(f"{_LINE}language: "), language,
        F.lit(f"{_LINE}payload-digest: "), digest, F.lit(_LINE),
    )
    made = [("metadata", "application/warc-fields", fields), ("conversion", "text/plain; charset=utf-8", None)]
    rows = F.array(
        *[
            F.struct(
                F.lit(kind).alias("record_type"),
                F.lit(content).alias("content_type"),
                (F.col("visible") if block is None else block).alias("block"),
            )
            for kind, content, block in made
        ]
    )
    source = source.withColumn("visible", to_text(F.col("payload")))
    one = source.withColumn("made", F.explode(rows)).withColumn("source_digest", digest)
    return one.select(
        *keep,
        "made.record_type",
        _identifier(F.col("made.record_type"), F.col("record_id"), F.col("source_digest")).alias("record_id"),
        F.col("record_id").alias("refers_to"),
        "target_uri",
        "date",
        "made.content_type",
        F.col("http_headers").alias("source_headers"),
        "source_digest",
        "made.block",
        _digest(F.col("made.block")).alias("block_digest"),
        F.octet_length(F.encode("made.block", "UTF-8")).cast("long").alias("content_length"),
    )


def serialise(records: DataFrame) -> DataFrame:
    """Each derived record as the bytes of one gzip member in column ``member``; members joined are an archive file."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [gzip.compress(record_bytes(row), mtime=0) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("record_id"), pa.array(out, pa.binary())], ["record_id", "member"]
            )

    return records.mapInArrow(packed, "record_id string, member binary")


def record_bytes(row: dict) -> bytes:
    """A derived record in the archive format."""
    block = row["block"].encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {row['record_id']}",
        f"WARC-Refers-To: {row['refers_to']}",
        f"WARC-Target-URI: {row['target_uri']}",
        f"WARC-Date: {row['date']}",
        f"WARC-Block-Digest: {row['block_digest']}",
        f"Content-Type: {row['content_type']}",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record in an archive, plain or of gzip members."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data))
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:40]!r}")
        head: dict[str, str] = {}
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        yield head, stream.read(int(head.get("content-length", 0)))


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """The response records of archive files, in the columns of ``responses`` (without ``page_id``).

    A file is read by one task; chunked bodies and bytes that are no UTF-8 are decoded as far as they go.
    """

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record_id", "target_uri", "date", "http_headers", "payload"]
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for head, block in parse_records(content.as_py()):
                    if head.get("warc-type") == "response":
                        http, _, body = block.partition(b"\r\n\r\n")
                        keys = ("warc-record-id", "warc-target-uri", "warc-date")
                        texts = (http.decode("latin-1") + _LINE, _charset_decoded(http, body))
                        rows.append((*[head.get(k, "") for k in keys], *texts))
                columns = [pa.array(c, pa.string()) for c in (zip(*rows) if rows else [[]] * 5)]
                yield pa.RecordBatch.from_arrays(columns, names)

    files = spark.read.format("binaryFile").load(path).select("content")
    shape = "record_id string, target_uri string, date string, http_headers string, payload string"
    return files.mapInArrow(parsed, shape)


def _charset_decoded(http: bytes, body: bytes) -> str:
    named = re.search(rb"(?i)charset=([\w-]+)", http)
    try:
        return body.decode(named[1].decode() if named else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def record_digests(pages: DataFrame) -> DataFrame:
    """Derived records of all pages, with the block as length and digest; the text is that of the SQL twin."""
    return derive(responses(pages), "page_id", to_text=listed_text).drop("block", "source_headers", "date")


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle() -> str:
    """The query in DuckDB SQL: the same steps and identifiers, written out."""
    text = "coalesce(html, '')"
    for pattern, to in _STEPS:
        text = f"regexp_replace({text}, {_sql(pattern)}, {_sql(to)}, 'g')"
    for entity, to in _ENTITIES:
        text = f"replace({text}, {_sql(entity)}, {_sql(to)})"
    for pattern, to in _TIDY:
        text = f"regexp_replace({text}, {_sql(pattern)}, {_sql(to)}, 'g')"

    def identifier(joined: str) -> str:
        cuts = ", ".join(f"substr(md5({joined}), {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
        return f"'<urn:uuid:' || concat_ws('-', {cuts}) || '>'"

    source = "concat_ws('|', 'response', coalesce(CAST(page_id AS VARCHAR), ''), coalesce(url, ''), md5(payload))"
    fields = f"""'HTTP/1.1 200 OK' || {_sql(_LINE)} || 'http-Content-Type: text/html; charset=utf-8' || {_sql(_LINE)}
        || 'http-Content-Length: ' || strlen(payload) || {_sql(_LINE)} || 'title: '
        || regexp_replace(regexp_extract(payload, '(?is)<title[^>]*>(.*?)</title *>', 1), {_sql("[" + chr(13) + chr(10) + "]+")}, ' ', 'g')
        || {_sql(_LINE + "language: ")} || regexp_extract(payload, '(?i)<html[^>]* lang *= *"?([a-z-]+)', 1)
        || {_sql(_LINE + "payload-digest: ")} || source_digest || {_sql(_LINE)}"""
    return f"""
WITH given AS (SELECT *, coalesce(html, '') AS payload FROM pages),
named AS (SELECT *, {identifier(source)} AS refers_to, 'sha1:' || sha1(payload) AS source_digest FROM given),
made AS (
    SELECT *, 'metadata' AS record_type, 'application/warc-fields' AS content_type, {fields} AS block FROM named
    UNION ALL SELECT *, 'conversion', 'text/plain; charset=utf-8', {text} FROM named)
SELECT page_id, record_type, {identifier("concat_ws('|', record_type, refers_to, source_digest)")} AS record_id, refers_to,
    coalesce(url, '') AS target_uri, content_type, source_digest, 'sha1:' || sha1(block) AS block_digest,
    CAST(strlen(block) AS BIGINT) AS content_length FROM made
"""
