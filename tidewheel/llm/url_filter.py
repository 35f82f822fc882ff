"""URL verdicts with redirect equivalence, DataFrame and SQL functions only.

A rule names a host (with its subdomains) and the beginning of a path; the longest fitting
rule decides a url. Pages that point at each other by a canonical link or a refresh
redirect are aliases (every such tag counts; targets are resolved against the page): their connected components are found by distributed joins, and a
block reaches every alias that no rule speaks about, unless a rule allows another alias of the component.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.components import components
from tidewheel.scratch import materialise

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: str) -> str:
    """SQL: what follows the first ``://``; empty for null or a url without one."""
    return f"CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) ELSE '' END"


# The texts below are read alike by Spark and DuckDB; the oracle of the query is made of them too.
HOST = f"translate(regexp_extract(rest, '^[^/?#]*', 0), '{_UPPER}', '{_LOWER}')"
PATH = "regexp_extract(rest, '^[^/?#]*([^?#]*)', 1)"
_TAGS = (
    "(?i)<link [^>]*rel *= *[^a-z>]?canonical[^>]*>",
    "(?i)<meta [^>]*http-equiv *= *[^a-z>]?refresh[^>]*>",
)
# All canonical links and refreshes of a page, and what one of them points at.
TAGS = " || ".join(f"regexp_extract_all(coalesce(html, ''), '{tag}', 0)" for tag in _TAGS)
_HREF = """regexp_extract(tag, '(?i) href *= *"?([^ >"]+)', 1)"""
_REFRESH_URL = """regexp_extract(tag, '(?i)url *= *([^ >"]+)', 1)"""
LINK = f"""replace(replace(CASE WHEN regexp_extract(tag, '(?i)^<link', 0) <> '' THEN {_HREF} ELSE {_REFRESH_URL} END,
    chr(39), ''), '&amp;', '&')"""
# What follows the scheme of a link's target, given the host and path of the page that holds it.
TARGET = f"""CASE WHEN regexp_extract(link, '^[A-Za-z][A-Za-z0-9+.-]*://', 0) <> '' THEN {_after_scheme("link")}
    WHEN substr(link, 1, 2) = '//' THEN substr(link, 3)
    WHEN substr(link, 1, 1) = '/' THEN host || link
    WHEN substr(link, 1, 1) = '?' THEN host || path || link
    ELSE host || regexp_extract(path, '^(.*/)?', 0) || CASE WHEN instr(path, '/') > 0 THEN '' ELSE '/' END || link END"""
POINTS = "link <> '' AND substr(link, 1, 1) <> '#'"  # a fragment is the page itself


def _name(fold: str) -> str:
    """SQL: a page's name among its aliases: host in lower case, path, query; no scheme, no fragment; no host, no name.

    An empty path is ``/``, and the segments ``.`` and ``..`` are resolved. ``fold`` is the engine's way to write a left fold
    of ``{items}`` from ``''`` by a function of ``done`` and ``part`` whose body is ``{step}``.
    """
    step = "CASE part WHEN '.' THEN done WHEN '..' THEN regexp_replace(done, '/[^/]*$', '') ELSE done || '/' || part END"
    folded = fold.format(items=f"split(substr({PATH}, 2), '/')", step=step)
    ends_open = f"CASE WHEN regexp_extract({PATH}, '/[.][.]?$', 0) <> '' THEN '/' ELSE '' END"
    return f"CASE WHEN host = '' THEN '' ELSE host || {folded} || {ends_open} || regexp_extract(rest, '^[^?#]*([?][^#]*)', 1) END"


NAME = _name("aggregate({items}, '', (done, part) -> {step})")


def parse_urls(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host``, ``path`` and ``name``."""
    return (
        pages.withColumn("rest", F.expr(_after_scheme(f"`{url}`")))
        .withColumn("rest", F.coalesce("rest", F.lit("")))
        .withColumn("host", F.expr(HOST))
        .withColumn("path", F.expr(PATH))
        .withColumn("name", F.expr(NAME))
        .drop("rest")
    )


def _rule_parts(rule: str) -> tuple[str, str]:
    at = rule.index("/")
    return rule[:at].translate(str.maketrans(_UPPER, _LOWER)), rule[at:]


def deciding_rule(rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits ``host`` and ``path``, as struct ``rule, verdict``; null if none fits.

    ``rules`` are (``host/path``, verdict) and become part of the plan, so their list should stay in the thousands.
    Of two rules with equal text the allowing one decides.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[0]), r[1] != ALLOW, r[0]))
    found = None
    for rule, verdict in ordered:
        name, start = _rule_parts(rule)
        fits = (F.col("host") == name) | F.col("host").endswith("." + name)
        hit = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        fits = fits & F.col("path").startswith(start)
        found = F.when(fits, hit) if found is None else found.when(fits, hit)
    return F.lit(None).cast("struct<rule: string, verdict: string>") if found is None else found


def alias_edges(pages: DataFrame) -> DataFrame:
    """Distinct edges ``a, b`` from each page's name to the names its canonical and refresh links point at."""
    tags = pages.select("name", "host", "path", F.explode(F.expr(TAGS)).alias("tag"))
    links = tags.withColumn("link", F.expr(LINK)).where(POINTS)
    targets = links.select("name", F.expr(TARGET).alias("rest")).withColumn("host", F.expr(HOST))
    return targets.select(F.col("name").alias("a"), F.expr(NAME).alias("b")).where("host <> '' AND a <> ''").distinct()


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    redirects: DataFrame | None = None,
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, via_alias``.

    ``redirects`` may add edges as columns ``source, target`` of urls. A page with a rule
    keeps the rule's verdict. A page without one is blocked if its component of aliases
    holds a blocked page and no allowed one, else allowed. Null urls and urls
    without ``://`` have no host, fit no rule and are no aliases. Null html has no links.
    Repeated rows are judged alike; other columns do not matter. Runs jobs while it builds the result.
    """
    given = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html")
    )
    known = parse_urls(given)
    edges = alias_edges(known)
    if redirects is not None:
        ends = parse_urls(parse_urls(redirects, "source").withColumnRenamed("name", "a").drop("host", "path"), "target")
        edges = edges.union(ends.select("a", F.col("name").alias("b")).where("a <> '' AND b <> ''")).distinct()
    ruled = known.select("page_id", "host", "path", "name", deciding_rule(rules).alias("hit"))
    aliases = components(edges, "a", "b").toDF("name", "component")
    # A name may be linked to without being a page; rules speak about it all the same.
    judged = (
        aliases.withColumn("rest", F.col("name"))
        .withColumn("host", F.expr(HOST))
        .withColumn("path", F.expr(PATH))
        .withColumn("hit", deciding_rule(rules))
    )
    spread = (
        judged.groupBy("component")
        .agg(
            F.bool_or(F.coalesce(F.col("hit.verdict") == BLOCK, F.lit(False))).alias("blocked"),
            F.bool_or(F.coalesce(F.col("hit.verdict") == ALLOW, F.lit(False))).alias("allowed"),
        )
        .where("blocked AND NOT allowed")
    )
    reached = materialise(aliases.join(spread, "component").select("name", F.lit(True).alias("reached")), "reached")
    by_alias = F.col("hit").isNull() & F.col("reached").isNotNull()
    return ruled.join(reached, "name", "left").select(
        "page_id",
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", F.when(by_alias, BLOCK).otherwise(ALLOW)).alias("verdict"),
        by_alias.alias("via_alias"),
    )


RULES = [
    ("org/", ALLOW),
    ("example.org/es/", BLOCK),
    ("example.org/en/1", BLOCK),
    ("com/fr/", ALLOW),
    ("com/de/", BLOCK),
]


def oracle(rules: list[tuple[str, str]]) -> str:
    """DuckDB SQL for the query: rules by a join, components by recursion over the same edges."""
    name = _name("list_reduce({items}, lambda done, part: {step}, '')")
    rows = ", ".join(f"('{r}', '{_rule_parts(r)[0]}', '{_rule_parts(r)[1]}', '{v}')" for r, v in rules)
    fitted = """SELECT n.*, (SELECT struct_pack(rule := r.rule, verdict := r.verdict) FROM rules r
        WHERE (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.start)
        ORDER BY length(r.rule) DESC, r.verdict = 'block' LIMIT 1) AS hit"""
    return f"""
WITH RECURSIVE rules(rule, host, start, verdict) AS (VALUES {rows}),
rested AS (SELECT page_id, html, coalesce({_after_scheme("url")}, '') AS rest FROM pages),
hosted AS (SELECT *, {HOST} AS host, {PATH} AS path FROM rested),
named AS (SELECT page_id, html, host, path, {name} AS name FROM hosted),
tags AS (SELECT name, host, path, unnest({TAGS}) AS tag FROM named),
links AS (SELECT name, host, path, {LINK} AS link FROM tags),
targets AS (SELECT name AS a, {TARGET} AS rest FROM links WHERE {POINTS}),
ends AS (SELECT a, rest, {HOST} AS host FROM targets),
edges AS (SELECT DISTINCT a, {name} AS b FROM ends WHERE host <> '' AND a <> ''),
reach(a, b) AS (
    SELECT a, b FROM edges UNION SELECT b, a FROM edges
    UNION SELECT r.a, e.b FROM reach r JOIN (SELECT a, b FROM edges UNION SELECT b, a FROM edges) e ON r.b = e.a),
far AS (SELECT DISTINCT b AS rest FROM reach),
nodes AS (SELECT rest AS name, {HOST} AS host, {PATH} AS path FROM far),
fitting AS ({fitted} FROM nodes n),
spread AS (SELECT r.a AS name FROM reach r JOIN fitting f ON f.name = r.b GROUP BY r.a
    HAVING bool_or(coalesce(f.hit.verdict = 'block', false)) AND NOT bool_or(coalesce(f.hit.verdict = 'allow', false))),
ruled AS ({fitted} FROM named n)
SELECT page_id, host, path, hit.rule AS rule,
    coalesce(hit.verdict, CASE WHEN s.name IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
    hit IS NULL AND s.name IS NOT NULL AS via_alias
FROM ruled LEFT JOIN spread s ON s.name = ruled.name
"""
