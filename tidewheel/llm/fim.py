"""Fill-in-middle: cut texts into prefix, middle and suffix with one counted regular expression.

``regexp_count`` gives the number of units of a text; two cuts between them are drawn from a hash of
the id. The row's own pattern holds the counts, ``(unit{a}+)(unit{b-a}+)(rest)``, and one replacement by it
writes the three groups in their new order between sentinels. The quantifiers are possessive: the
matcher walks over the units in a loop, neither going back nor using stack, so texts may have any length.
All of it is built-in column functions; nothing is shuffled.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = r"\x20\x09-\x0D"
UNIT = rf"(?:[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+)"  # a word with the blanks before it, or blanks at the end


class Sentinels(NamedTuple):
    """Marks before the three parts. Each is ``<name>`` with a name of its own and no further brackets."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32 from a hash of the id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _quoted(mark: str) -> str:
    """A text that stands for itself in a replacement."""
    return mark.replace("\\", "\\\\").replace("$", "\\$")


def fill_in_middle(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = 42,
    rate: int = 50,
    spm_rate: int = 80,
    marks: Sentinels = Sentinels(),
) -> DataFrame:
    """One row per document: ``doc_id, text, n, form, prefix_chars, middle_chars, output``.

    ``n`` counts the units of the text, ``form`` is 'psm', 'spm' or 'plain', lengths are in code points and null for
    plain rows. ``rate`` percent of the rows are cut, ``spm_rate`` percent of those into the suffix-first form; both
    cuts and both choices depend on ``seed`` and the id alone. Null texts count as empty. Empty texts and those that
    hold a mark stay plain, so that :func:`restored` can always undo the cut. Rows are independent: repeated rows,
    null ids (cut like an empty id) and other columns do not matter.
    """
    given = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    h1, h2, h3, h4 = (F.col(f"_h{k}") for k in range(1, 5))
    counted = given.select(
        "*",
        F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"),
        *[h.alias(f"_h{k}") for k, h in enumerate(_draws(F.col("doc_id"), seed), 1)],
    )
    whole = (F.col("text") == "") | (h3 % 100 >= rate)
    for mark in marks:
        whole = whole | F.contains("text", F.lit(mark))
    form = F.when(whole, "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm")
    ends = [h % (F.col("n") + 1) for h in (h1, h2)]
    drawn = counted.select("doc_id", "text", "n", form.alias("form"), F.least(*ends).alias("_a"), F.greatest(*ends).alias("_b"))
    pattern = F.concat(
        F.lit(rf"(?s)\A({UNIT}{{"), "_a", F.lit(rf"}}+)({UNIT}{{"), F.col("_b") - F.col("_a"), F.lit("}+)(.*)")
    )
    p, s, m = map(_quoted, marks)
    order = F.when(F.col("form") == "psm", F.lit(f"{p}$1{s}$3{m}$2")).otherwise(F.lit(f"{s}$3{p}$1{m}$2"))
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    cut = drawn.select("doc_id", "text", "n", "form", output.alias("output"))
    parts = _parts(marks)
    return cut.select(
        "doc_id",
        "text",
        "n",
        "form",
        F.char_length(parts["prefix"]).cast("long").alias("prefix_chars"),
        F.char_length(parts["middle"]).cast("long").alias("middle_chars"),
        "output",
    )


def _parts(marks: Sentinels) -> dict[str, Column]:
    """Prefix, middle and suffix of ``output``; null if it is plain.

    Every mark occurs once: it begins and ends with a bracket, so no text beside it can make up a second one.
    """
    output, suffix_first = F.col("output"), F.col("form") == "spm"

    def between(first: str, second: str) -> Column:
        return F.substring_index(F.substring_index(output, first, -1), second, 1)

    prefix = F.when(suffix_first, between(marks.prefix, marks.middle)).otherwise(between(marks.prefix, marks.suffix))
    suffix = F.when(suffix_first, between(marks.suffix, marks.prefix)).otherwise(between(marks.suffix, marks.middle))
    middle = F.substring_index(output, marks.middle, -1)
    cut = F.col("form") != "plain"
    return {name: F.when(cut, part) for name, part in (("prefix", prefix), ("middle", middle), ("suffix", suffix))}


def restored(marks: Sentinels = Sentinels()) -> Column:
    """The text as it was, from the columns ``output`` and ``form``."""
    parts = _parts(marks)
    joined = F.concat(parts["prefix"], parts["middle"], parts["suffix"])
    return F.when(F.col("form") == "plain", F.col("output")).otherwise(joined)


def digests(docs: DataFrame) -> DataFrame:
    """The cut documents with digests in place of the texts."""
    return fill_in_middle(docs).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"),
    )


# The same rows from lists of units.
ORACLE = rf"""
WITH listed AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{UNIT}') AS u,
        sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
    SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
        CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM listed),
cut AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
            THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
    SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
        array_to_string(u[b + 1:], '') AS s FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts
"""
