"""URL verdicts: host and path rules, then a list of URLs behind a blocked Bloom filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riboscan.llm.bloom import BlockedBloom
from riboscan.llm.core import Workspace, table

#: (verdict, host, path)
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and without ``://``."""
    whole = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    u = F.coalesce(F.col(url), F.lit(""))
    return F.translate(F.regexp_extract(u, whole, 1), _UPPER, _LOWER), F.regexp_extract(u, whole, 2)


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.``, path without a closing slash; null without a host."""
    return F.when(host != "", F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, "/+$", "")))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (as host + path) and its verdict; null without one."""
    name = verdict = None
    for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)) if name is None else name.when(fits, F.lit(h + p))
        verdict = F.when(fits, F.lit(v)) if verdict is None else verdict.when(fits, F.lit(v))
    return (name, verdict) if rules else (F.lit(None).cast("string"),) * 2


def judge_urls(spark: SparkSession, pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict for each row of ``pages`` (page_id, url).

    A fitting rule decides; else a URL whose canonical form is that of a row of
    ``listed`` (url) is blocked, any other allowed. Only URLs that the Bloom
    filter may hold go on to the exact hash join. Null and odd URLs have empty
    host and path and are allowed; null and repeated rows of ``listed`` count
    once or not at all. Other columns aren't read.
    """
    ws = Workspace(spark, "urls")
    host, path = host_and_path("url")
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    parsed = split.withColumn("rule", rule).withColumn("verdict", verdict).withColumn("canonical", canonical(F.col("host"), F.col("path")))
    known = ws.keep(listed.select(canonical(host, path).alias("canonical")).filter("canonical is not null").distinct(), "listed")
    bloom = BlockedBloom.of_ids(known)
    ruled = parsed.filter("rule is not null")
    rest = parsed.filter("rule is null")
    none = bloom.maybe(rest, "canonical", hit=False).withColumn("verdict", F.lit("allow"))
    hits = bloom.maybe(rest, "canonical").join(known.withColumn("_listed", F.lit(True)).hint("shuffle_hash"), "canonical", "left")
    hits = hits.withColumn("verdict", F.when(F.col("_listed"), F.lit("block")).otherwise(F.lit("allow")))
    names = ["page_id", "host", "path", "rule", "verdict"]
    return ruled.select(names).union(none.select(names)).union(hits.select(names))


def op7_bloom_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed are the pages of every host with a label ``spam-farm``."""
    pages = table(spark, sf_dir, "pages")
    listed = pages.filter(host_and_path("url")[0].rlike(r"(^|\.)spam-farm\.")).select("url")
    return judge_urls(spark, pages, listed)


OP7_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
h AS (SELECT page_id, r, regexp_extract(r, '^[^/?#]*') AS raw FROM u),
s AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(r, length(raw) + 1), '^[^?#]*') AS path FROM h),
rules(verdict, rh, rp) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
f AS (SELECT s.page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(verdict, length(rh || rp)) AS verdict
      FROM (SELECT DISTINCT page_id, host, path FROM s) s JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY 1),
c AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') END AS canonical FROM s),
l AS (SELECT DISTINCT canonical FROM c WHERE regexp_matches(host, '(^|\.)spam-farm\.') AND canonical IS NOT NULL)
SELECT c.page_id, host, path, f.rule, coalesce(f.verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN f ON c.page_id = f.page_id LEFT JOIN l ON c.canonical = l.canonical
"""
