"""The order of a crawl: stored pages by their distance from root pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townads.operators import crawl
from townads.session import scratch_folder


def crawl_levels(pages: DataFrame, roots: list[str], domains: list[str]) -> DataFrame:
    """Pages that a crawl from ``roots`` reaches over links within ``domains``, with their ``level``: the
    least number of links to follow. Columns url (in the one spelling of requests) and level. Batch only.

    Roots that are not stored are left out, as is what only pages reach that are not stored. A page that
    is stored several times is one page with the links of all its copies.
    """
    spark = pages.sparkSession
    keyed = crawl.with_request_key(pages.select("page_id", "url"), "source").select("page_id", "source")
    links = crawl.in_domains(crawl.extract_links(pages), domains)
    targets = crawl.with_request_key(links.select("page_id", "url"), "target").select("page_id", "target").distinct()
    stored = keyed.select(F.col("source").alias("url")).distinct()
    edges = targets.join(keyed, "page_id").select("source", "target").distinct().where("source <> target")
    folder = scratch_folder(spark, "links")
    edges.join(stored, edges.target == stored.url, "left_semi").write.parquet(folder)
    edges = spark.read.schema("source string, target string").parquet(folder)
    wanted = crawl.with_request_key(spark.createDataFrame([(root,) for root in roots], "root string"), "url", "root")
    return levels(edges, stored.join(wanted.select("url").distinct(), "url", "left_semi"))


def levels(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Nodes (url) reachable from ``roots`` (url) over ``edges`` (source, target) with their least ``level``.

    Breadth first: each round follows the links of the newest level only, leaves out what any level has, and
    writes the rest as the next level. A round that is run again after a loss writes the same level; nothing
    is kept but the table. Rounds are as many as the farthest node is links away.
    """
    spark = edges.sparkSession
    folder = scratch_folder(spark, "levels")
    roots.select("url").distinct().write.parquet(f"{folder}/level=0")
    level = 0
    while True:
        visited = spark.read.schema("url string, level int").parquet(folder)
        newest = visited.where(F.col("level") == level).select(F.col("url").alias("source"))
        reached = edges.join(newest, "source").select(F.col("target").alias("url")).distinct()
        following = f"{folder}/level={level + 1}"
        reached.join(visited.select("url"), "url", "left_anti").write.parquet(following)
        if spark.read.schema("url string").parquet(following).isEmpty():
            return visited
        level += 1
