"""Ads as a table by scrape day: a range of time reads the files of its days only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from townads.functions import times
from townads.schema import AD_MESSAGE

DAY = "scraped_day"


def write_ads(ads: DataFrame, path: str, mode: str = "append") -> None:
    """Adds ads to the table. Ads without a readable time go to a day of their own, which no range reads.

    Rows are dealt by range of time, so a day with most of the ads is written by several tasks, a task
    writes few days, and the times within a file lie close together, which lets ranges skip parts of files.
    """
    dated = ads.withColumn(DAY, times.event_time(F.col("scraped_time")).cast("date"))
    dated.repartitionByRange(DAY, "scraped_time").write.partitionBy(DAY).mode(mode).parquet(path)


def read_ads(spark: SparkSession, path: str) -> DataFrame:
    """The ads with their day, which is known from the folder names."""
    return spark.read.schema(AD_MESSAGE.simpleString()[7:-1].replace(":", " ") + f", {DAY} date").parquet(path)


def between(ads: DataFrame, first: Column, last: Column) -> DataFrame:
    """Ads of the days from that of ``first`` to that of ``last``; other days are not read."""
    return ads.where((F.col(DAY) >= first.cast("date")) & (F.col(DAY) <= last.cast("date")))


def newest(ads: DataFrame) -> DataFrame:
    """Ads of the latest day. Finding it reads no column of the files."""
    return ads.where(F.col(DAY) == ads.agg(F.max(DAY)).scalar())
