"""Benchmark decontamination on a distributed positional inverted index, DataFrame functions only.

The index is a stored table of postings ``doc_row, term_id, pos`` of the benchmark's
vocabulary, written in document order by the tasks that read the documents: nothing is shuffled to
build it. Every document ends with a marker posting whose position is its number of words.

A phrase occurs at word s of a document if each of its words k has a posting at s + k.
For every window of a test item the two terms with the fewest postings are picked; only
their lists are read, shifted by the term's offset, and intersected. The few places that
survive are then checked against the lists of all terms of the item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewheel.llm.joins import keep_ids, stored_ids
from tidewheel.scratch import materialise

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_TERMS = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_END = " "  # a blank is never a word


def words(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, digits, letters and all characters beyond ASCII; null has none."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), BREAKS), "")


def vocabulary(items: DataFrame) -> DataFrame:
    """Stored ``term, term_id`` of all words in ``items.words``, and the end marker."""
    terms = items.select(F.explode("words").alias("term")).union(
        items.sparkSession.createDataFrame([(_END,)], "term string")
    )
    return materialise(terms.distinct().withColumn("term_id", F.monotonically_increasing_id()), "vocabulary")


def build_index(docs: DataFrame, doc_id: str, text: str, terms: DataFrame) -> DataFrame:
    """Store the postings ``doc_row, doc_id, term_id, pos`` of every term in the vocabulary.

    ``doc_row`` numbers rows, so repeated or null ids stay apart; ``doc_id`` is filled at end markers only.
    """
    numbered = docs.select(  # numbered before words are listed: afterwards every word would get a number
        F.monotonically_increasing_id().alias("doc_row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")
    )
    listed = numbered.select(
        "doc_row", "doc_id", F.posexplode(F.array_append(words(F.col("text")), F.lit(_END))).alias("pos", "term")
    )
    small = terms.count() <= BROADCAST_TERMS
    postings = listed.join(F.broadcast(terms) if small else terms, "term")
    marked = F.when(F.col("term") == _END, F.col("doc_id")).alias("doc_id")
    return materialise(postings.select("doc_row", marked, "term_id", "pos"), "postings")


def phrases(index: DataFrame, terms: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """Exact occurrences of the items' windows: ``doc_row, item, item_id, start, length`` of maximal runs.

    ``items`` has ``item, item_id, words``. A window is ``size`` consecutive words, or the whole of a shorter item.
    """
    counts = index.groupBy("term_id").agg(F.count("*").alias("postings"))
    item_terms = materialise(
        items.select("item", "item_id", F.size("words").alias("n"), F.posexplode("words").alias("k", "term"))
        .join(terms, "term")
        .join(counts, "term_id", "left")
        .select("item", "item_id", "n", "k", "term_id", F.coalesce("postings", F.lit(0)).alias("postings")),
        "item-terms",
    )
    span = F.least("n", F.lit(size))
    # Each word belongs to the windows that start up to span - 1 words before it.
    windows = item_terms.withColumn(
        "w", F.explode(F.sequence(F.greatest(F.col("k") - span + 1, F.lit(0)), F.least("k", F.col("n") - span)))
    )
    rarest = Window.partitionBy("item", "w").orderBy("postings", "k")
    picked = (
        windows.withColumn("rank", F.row_number().over(rarest))
        .withColumn("least", F.min("postings").over(Window.partitionBy("item", "w")))
        .where("rank <= 2 AND least > 0")
        .select("item", "k", "term_id", F.least("n", F.lit(2)).alias("needed"))
        .distinct()
    )
    picked = materialise(picked, "picked")
    small = picked.count() <= BROADCAST_TERMS
    starts = (
        index.join(F.broadcast(picked) if small else picked, "term_id")
        .groupBy("doc_row", "item", (F.col("pos") - F.col("k")).alias("start"))
        .agg(F.count("*").alias("met"), F.min("needed").alias("needed"))
        .where("met >= needed")
        .select("doc_row", "item", "start")
    )
    starts = materialise(starts, "starts")
    wanted = starts.join(item_terms.select("item", "item_id", "n", "k", "term_id"), "item").withColumn(
        "pos", (F.col("start") + F.col("k")).cast("int")
    )
    near = keep_ids(index.select("doc_row", "term_id", "pos"), stored_ids(starts, "doc_row"), "doc_row")
    matched = wanted.join(near, ["doc_row", "pos", "term_id"])
    place = Window.partitionBy("doc_row", "item", "start").orderBy("k")
    return (
        matched.withColumn("run", F.col("k") - F.row_number().over(place))
        .groupBy("doc_row", "item", "start", "run")
        .agg(
            F.first("item_id").alias("item_id"),
            F.first("n").alias("n"),
            F.min("pos").alias("first"),
            F.count("*").alias("length"),
        )
        .where(F.col("length") >= F.least("n", F.lit(size)))
        .select("doc_row", "item", "item_id", F.col("first").alias("start"), "length")
    )


def proximity(index: DataFrame, terms: DataFrame, items: DataFrame, within: int) -> DataFrame:
    """``doc_row, item, item_id, start``: places from which ``within`` words hold all distinct words of the item.

    Only documents with a posting of the item's rarest term are looked at.
    """
    counts = index.groupBy("term_id").agg(F.count("*").alias("postings"))
    asked = (
        items.select("item", "item_id", F.explode(F.array_distinct("words")).alias("term"))
        .join(terms, "term")
        .join(counts, "term_id", "left")
        .withColumn("n", F.count("*").over(Window.partitionBy("item")))
    )
    rare = asked.groupBy("item").agg(F.min_by("term_id", F.coalesce("postings", F.lit(0))).alias("term_id"))
    holding = index.join(rare, "term_id").select("doc_row", "item").distinct()
    lists = index.select("doc_row", "term_id", "pos").join(asked.select("item", "item_id", "n", "term_id"), "term_id")
    lists = lists.join(holding, ["doc_row", "item"])
    ahead = Window.partitionBy("doc_row", "item").orderBy("pos").rangeBetween(0, within - 1)
    return (
        lists.withColumn("met", F.size(F.collect_set("term_id").over(ahead)))
        .where("met = n")
        .select("doc_row", "item", "item_id", F.col("pos").alias("start"))
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = 10,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    A word is hit if it lies in an occurrence of a window of ``size`` item words (an item of
    fewer words is one window). ``n_items`` counts distinct item ids with an occurrence;
    their sorted, comma-joined list is hashed, an empty list as the empty string. Null,
    empty and wordless texts have no words; items without words match nothing; a null item
    id hits words but is not listed. Repeated rows and null document ids are judged row by
    row. Runs jobs while it builds the result.
    """
    tests = materialise(
        items.select(
            F.monotonically_increasing_id().alias("item"),
            F.col(item_id).cast("string").alias("item_id"),
            words(F.col(item_text)).alias("words"),
        ).where("size(words) > 0"),
        "items",
    )
    terms = vocabulary(tests)
    index = build_index(docs, doc_id, text, terms)
    found = materialise(phrases(index, terms, tests, size), "phrases")
    hit = (
        found.select("doc_row", F.explode(F.expr("sequence(start, start + CAST(length AS INT) - 1)")).alias("pos"))
        .distinct()
        .groupBy("doc_row")
        .agg(F.count("*").alias("n_hit"))
    )
    listed = found.groupBy("doc_row").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    end = terms.where(F.col("term") == _END).select("term_id")
    return (
        index.join(F.broadcast(end), "term_id")  # one row
        .select("doc_row", "doc_id", F.col("pos").cast("long").alias("n_words"))
        .join(hit, "doc_row", "left")
        .join(listed, "doc_row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


# The same rows by brute force: every n-gram of every document against every window.
ORACLE = rf"""
WITH lowered AS (
    SELECT 'doc' AS kind, CAST(doc_id AS VARCHAR) AS id, text FROM documents
    UNION ALL SELECT 'item', CAST(item_id AS VARCHAR), text FROM benchmark),
listed AS (
    SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
windows AS (
    SELECT id AS item_id, least(len(w), 10) AS n, unnest(list_transform(range(0, len(w) - least(len(w), 10) + 1),
        lambda i: array_to_string(w[i + 1 : i + least(len(w), 10)], ' '))) AS gram
    FROM listed WHERE kind = 'item' AND len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
    SELECT id, n, unnest(range(0, len(w) - n + 1)) AS s,
        unnest(list_transform(range(0, len(w) - n + 1), lambda i: array_to_string(w[i + 1 : i + n], ' '))) AS gram
    FROM listed, sizes WHERE kind = 'doc' AND len(w) >= n),
found AS (SELECT DISTINCT id, s, g.n, item_id FROM grams g JOIN windows w ON g.n = w.n AND g.gram = w.gram),
hit AS (SELECT id, count(DISTINCT p) AS n_hit
    FROM (SELECT id, unnest(range(s, s + n)) AS p FROM found) GROUP BY id),
named AS (SELECT id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT id, item_id FROM found) GROUP BY id)
SELECT CAST(l.id AS BIGINT) AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM listed l LEFT JOIN hit USING (id) LEFT JOIN named USING (id) WHERE kind = 'doc'
"""
