"""Operator 8: URL filter.

Rules (host, path, verdict) judge a url first; the longest that fits wins. What no rule fits is
judged by a list of URLs: a blocked Bloom filter of the listed canonical URLs lets possible
hits through to an exact hash join, which removes the filter's false positives. Everything is
DataFrame expressions.

* The filter (``bloom.py``) is a table of ``MAX_BLOCKS`` rows at most, so it can be broadcast
  whatever the length of the list. A list that fills it lets more false positives through,
  which the join removes.
* Only possible hits are shuffled for the join, on their canonical URL, and the listed side has
  each URL once. Spark splits the rows of a URL that many pages share (adaptive skew join).

Defined results: a null url or one without ``://`` has an empty host and path, no rule, and
passes the list (``allow``); so has an empty url. Repeated rows are judged alike, an empty page
table gives an empty result, an empty list allows what no rule blocks, a null listed URL is
ignored, and other columns are ignored, whatever their names.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagecraft.llm.bloom import MAX_BLOCKS, with_maybe
from stagecraft.llm.common import lower_ascii

# The rules of the registered query.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@dataclasses.dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lowered, path); both empty without ``://``."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = lower_ascii(F.regexp_extract(after, r"^[^/?#]*", 0))
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def canonical_url(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` or ``m.``, and path without ``.html`` and the slashes at
    its end; scheme, query and fragment don't count. Null without a host."""
    short = F.regexp_replace(path, r"(\.html)?/*$", "")
    return F.when(host != "", F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), short))


def fits(rule: Rule, host: Column, path: Column) -> Column:
    at_host = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
    return at_host & F.startswith(path, F.lit(rule.path))


def by_rules(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(name of the longest rule that fits, its verdict); both null if none fits. Of equally
    long rules the one with the longer host wins, then a block."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.verdict == "block")):
        here = fits(rule, host, path)
        name = F.when(here, rule.name).otherwise(name)
        verdict = F.when(here, rule.verdict).otherwise(verdict)
    return name, verdict


def filter_urls(
    pages: DataFrame, listed: DataFrame, rules: list[Rule], max_blocks: int = MAX_BLOCKS
) -> DataFrame:
    """page_id, host, path, rule, verdict and listed (by the list alone) of every page.

    ``listed`` has canonical URLs in column ``url``, of any number, repeated or null.
    """
    listed = listed.select("url").where("url IS NOT NULL").distinct()
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = by_rules(rules, F.col("host"), F.col("path"))
    judged = parts.select(
        "*",
        rule.alias("rule"),
        verdict.alias("by_rule"),
        canonical_url(F.col("host"), F.col("path")).alias("url"),
    )
    judged = with_maybe(judged, "url", listed, "url", max_blocks)
    hits = judged.where("maybe").join(listed.withColumn("listed", F.lit(True)).hint("shuffle_hash"), "url", "left")
    passed = judged.where("NOT maybe").withColumn("listed", F.lit(False))
    return hits.unionByName(passed).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
        F.coalesce("listed", F.lit(False)).alias("listed"),
    )


def toxic_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The list of the registered query: canonical URLs of pages that ``labels`` marks toxic
    (page_id is the id of the document that the page was made of)."""
    host, path = url_parts(F.col("url"))
    toxic = labels.where("toxic = 1").select(F.col("doc_id").alias("page_id")).distinct()
    return (
        pages.select("page_id", "url")
        .join(toxic, "page_id", "left_semi")
        .select(host.alias("host"), path.alias("path"))
        .select(canonical_url(F.col("host"), F.col("path")).alias("url"))
    )


def url_query(spark, sf_dir: str) -> DataFrame:
    """Op 8 over all pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return filter_urls(pages, toxic_urls(pages, labels), [Rule(*r) for r in RULES])


URL_SQL = r"""
WITH parts AS (
    SELECT page_id,
        CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), cut AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
), canon AS (
    SELECT *, CASE WHEN host <> '' THEN
        regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(\.html)?/*$', '') END AS url
    FROM cut
), rules(host, path, verdict) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
        ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fitting AS (
    SELECT page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
        arg_max(r.verdict, length(r.host || r.path)) AS verdict
    FROM canon c JOIN rules r
        ON (c.host = r.host OR c.host LIKE '%.' || r.host) AND starts_with(c.path, r.path)
    GROUP BY page_id
), toxic AS (
    SELECT DISTINCT c.url FROM canon c JOIN labels l ON l.doc_id = c.page_id WHERE l.toxic = 1 AND c.url IS NOT NULL
)
SELECT c.page_id, c.host, c.path, f.rule,
    coalesce(f.verdict, CASE WHEN t.url IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
    t.url IS NOT NULL AS listed
FROM canon c LEFT JOIN fitting f USING (page_id) LEFT JOIN toxic t ON t.url = c.url
"""
