"""From stored pages to ads and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townads.functions import html, times, urls
from townads.functions.generated import once


def extract_ads(
    pages: DataFrame, scraped_time: Column, city_class: str = "ps-2", date_class: str = "px-3"
) -> DataFrame:
    """Zero or one ad per page.

    A page gives an ad when its URL is that of an ad and it has a non-empty city link. A page
    whose date text is no date gives none; a page without date text gives an ad without a date.
    """
    body = pages.filter(urls.is_ad_url(F.col("url"))).select("url", html.visible(F.col("html")).alias("body"))
    found = body.select(
        "url",
        urls.city_from_link(html.first_attribute(F.col("body"), "a", city_class, "href")).alias("city"),
        html.first_text(F.col("body"), "div", date_class).alias("date_text"),
    )
    ad = F.struct(
        urls.ad_id_from_url(F.col("url")).alias("ad_id"),
        F.col("city").alias("city"),
        times.posted_date(F.col("date_text")).alias("posted_date"),
        times.stamp(scraped_time).alias("scraped_time"),
        F.col("date_text").alias("date_text"),
    )
    # A generator keeps the lookups from being evaluated once more inside a pushed-down filter.
    usable = F.filter(
        F.array(ad),
        lambda a: (a.city != "") & (a.posted_date.isNotNull() | a.date_text.isNull()),
    )
    return found.select(F.inline(usable)).drop("date_text")


def extract_links(pages: DataFrame) -> DataFrame:
    """Distinct link targets per page, as written (``link``) and absolute (``url``); a page's ``base``
    takes the place of its own URL."""
    bodies = pages.select("page_id", "url", once(html.visible(F.col("html")).alias("body")))
    based = bodies.select("page_id", "url", "body", once(html.base(F.col("body")).alias("base")))
    start = F.coalesce(urls.absolute(F.col("base"), F.col("url")), F.col("url"))
    started = based.select("page_id", "body", once(start.alias("page_url")))
    parts = started.select("page_id", "body", once(*urls.page_parts(F.col("page_url"))))
    links = parts.select("page_id", "origin", "path", "whole", F.explode(html.links(F.col("body"))).alias("link"))
    url = urls.resolved(*(F.col(c) for c in ("link", "origin", "path", "whole")))
    return links.select("page_id", "link", once(url.alias("url")))


def in_domains(links: DataFrame, domains: list[str]) -> DataFrame:
    """Links that may be followed: web links to pages in the domains or their sub-domains."""
    allowed = F.lit(False)
    for domain in domains:
        allowed = allowed | urls.in_domain(F.col("url"), domain)
    return links.filter(urls.is_fetchable(F.col("url")) & urls.is_page(F.col("url")) & allowed)


def with_request_key(rows: DataFrame, name: str, url: str = "url") -> DataFrame:
    """Adds the one spelling of ``url`` as a column ``name``."""
    parts = rows.select("*", once(F.struct(*urls.key_parts(F.col(url))).alias("_parts")))
    key = urls.joined_key(*(F.col(f"_parts.{c}") for c in ("bare", "query", "origin", "path")))
    return parts.select(*rows.columns, once(key.alias(name)))


def frontier(links: DataFrame, seen: DataFrame) -> DataFrame:
    """URLs to fetch next: linked, not seen yet, each once and in one spelling.

    Links are reduced to distinct ones before the anti join, so a link on every page is one row
    per task by the time it is shuffled.
    """
    wanted = with_request_key(links.select(F.col("url").alias("_url")), "url", "_url").select("url").distinct()
    known = with_request_key(seen.select(F.col("url").alias("_url")), "url", "_url").select("url").distinct()
    return wanted.join(known, "url", "left_anti")
