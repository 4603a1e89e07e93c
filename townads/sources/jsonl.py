"""JSONL files: one object per line, read with a declared schema and split across tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townads.functions import times
from townads.schema import AD_ITEM, AD_PAIR


def read_ads(
    spark: SparkSession, path: str, schema: T.StructType = AD_ITEM, streaming: bool = False, **options: str
) -> DataFrame:
    reader = (spark.readStream if streaming else spark.read).options(**options)
    return reader.schema(schema).json(path)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Only the two columns the count jobs declare."""
    return read_ads(spark, path, AD_PAIR)


def epoch_rows(ads: DataFrame) -> DataFrame:
    """Ads as ``(ts_ms, ad_id, city)`` with the scrape time in epoch milliseconds."""
    return ads.select(
        times.to_epoch_millis(times.iso_time(F.col("scraped_time"))).alias("ts_ms"), "ad_id", "city"
    )


def from_elements(spark: SparkSession, rows: list, schema: T.StructType = AD_PAIR) -> DataFrame:
    """A few literal rows as a table, for fixtures and reference data."""
    return spark.createDataFrame(rows, schema)


def write_ads(ads: DataFrame, path: str) -> None:
    """Replaces ``path``; fields without a value are written as null."""
    ads.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
