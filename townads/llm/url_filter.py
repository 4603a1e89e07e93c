"""Allow and block rules for URLs, with decisions shared among aliases; column expressions only.

A URL's own rule decides. A URL without one takes the decision of its aliases: URLs joined to it, over
any number of steps, by redirects, canonical links or by being spellings of one address. If rules allow
any alias it is allowed, else if they block any it is blocked, else it is allowed.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from townads.llm.frames import components, table

MAX_RULES = 2000  # they become constants of the plan
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """Fits the host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def address(url: Column) -> Column:
    """One spelling for URLs that only differ in scheme, letter case of the host, default port, fragment,
    a slash at the end or parameters that only track visits; null for what has no ``://``."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    parameters = F.filter(F.split(query, "&"), lambda x: ~x.rlike(r"^(utm_[a-z]+|ref|gclid|fbclid)=|^$"))
    asked = F.when(F.size(parameters) > 0, F.concat(F.lit("?"), F.array_join(parameters, "&"))).otherwise(F.lit(""))
    plain = F.concat(F.regexp_replace(host(url), r":(80|443)$", ""), F.regexp_replace(path(url), r"/+$", ""), asked)
    return F.when(F.instr(url, "://") > 0, plain)


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Aliases that pages name: a row (``a``, ``b``) of the page's URL and a target for each of its canonical
    links and immediate refreshes. Relative targets are resolved against the page's URL."""
    canonical = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"), F.lit(0))
    refresh = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"), F.lit(0))
    named = F.concat(
        F.transform(canonical, lambda x: F.regexp_extract(x, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)),
        F.transform(refresh, lambda x: F.regexp_extract(x, r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1)),
    )
    target = F.col("target")
    scheme = F.regexp_extract(F.col(url), r"^(.*?://)", 1)
    site = F.concat(scheme, F.regexp_extract(_rest(F.col(url)), r"^[^/?#]*", 0))
    folder = F.concat(site, F.regexp_extract(path(F.col(url)), r"^(?:.*/)?", 0))
    whole = (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(F.regexp_replace(scheme, "//$", ""), target))
        .when(target.startswith("/"), F.concat(site, target))
        .otherwise(F.concat(folder, target))
    )
    # An outer explode, as in licenses; other columns may have the names made here, so they are left out.
    found = pages.select(url, F.explode_outer(F.array_distinct(F.array_remove(named, ""))).alias("target"))
    return found.select(F.col(url).alias("a"), whole.alias("b")).where("a IS NOT NULL AND b IS NOT NULL")


def _own_rule(rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, an allowing one before a blocking one of equal length."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.host) + len(r.path), r.verdict == "allow")):
        fits = F.concat(F.lit("."), F.col("host")).endswith(f".{rule.host}") & F.col("path").startswith(rule.path)
        made = F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, made).otherwise(found)
    return found


def judge(
    pages: DataFrame,
    links: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``.

    ``links`` holds rows (``a``, ``b``) of URLs that are aliases; URLs of one ``address`` always are.
    Of several rules the longest wins, of equally long ones the allowing.

    Nulls and edges: a null URL, or one without ``://``, has an empty host and path, no aliases and is
    allowed unless a rule fits; links with a null or such a URL are ignored; null or repeated ids are
    rows of their own; repeated links count once; other columns are not read.
    """
    own = (
        pages.select(F.col(id).alias("id"), F.col(url).alias("url"))
        .withColumns({"host": F.coalesce(host(F.col("url")), F.lit("")), "path": F.coalesce(path(F.col("url")), F.lit(""))})
        .withColumn("own", _own_rule(rules))
        .select("id", "host", "path", "own.rule", F.col("own.verdict").alias("said"), address(F.col("url")).alias("address"))
    )
    found = components(
        links.select(address(F.col("a")).alias("a"), address(F.col("b")).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    )
    placed = own.join(found, own.address == found.node, "left").withColumn("group", F.coalesce("component", "address"))
    # Combined before the shuffle, so a group of any size sends a row for each task.
    shared = (
        placed.where("said IS NOT NULL AND group IS NOT NULL")
        .groupBy("group")
        .agg(F.min("said").alias("shared"))  # allow comes before block
    )
    return placed.join(shared, "group", "left").select(
        F.col("id").alias(id), "host", "path", "rule", F.coalesce("said", "shared", F.lit("allow")).alias("verdict")
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by its URL, the links that pages name and the spelling of addresses."""
    pages = table(spark, sf_dir, "pages")
    return judge(pages, page_links(pages))


QUERIES = {"op7_url_filter": op7_url_filter}

_RULE_ROWS = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)
_REST = "CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
ORACLE = {
    # Pages here name no canonical link or refresh, so groups are the pages of one address.
    "op7_url_filter": rf"""
WITH cut AS (
  SELECT page_id, coalesce({_REST}, '') AS rest, coalesce(strpos(url, '://'), 0) > 0 AS whole FROM pages
), part AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda x: NOT regexp_matches(x, '^(utm_[a-z]+|ref|gclid|fbclid)=|^$')) AS asked, whole
  FROM cut
), own AS (
  SELECT page_id, host, path,
    CASE WHEN whole THEN regexp_replace(host, ':(80|443)$', '') || regexp_replace(path, '/+$', '')
      || CASE WHEN len(asked) > 0 THEN '?' || array_to_string(asked, '&') ELSE '' END END AS address,
    (SELECT arg_max({{'rule': r.host || r.path, 'verdict': r.verdict}}, length(r.host || r.path) * 2 + (r.verdict = 'allow')::INT)
     FROM (VALUES {_RULE_ROWS}) r(verdict, host, path)
     WHERE ends_with('.' || part.host, '.' || r.host) AND starts_with(part.path, r.path)) AS own
  FROM part
)
SELECT page_id, host, path, own.rule AS rule,
  coalesce(own.verdict, CASE WHEN address IS NOT NULL THEN min(own.verdict) OVER (PARTITION BY address) END, 'allow') AS verdict
FROM own
"""
}
