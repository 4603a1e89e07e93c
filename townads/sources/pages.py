"""Stored web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from townads.schema import PAGE


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE).parquet(path)


def stream_pages(spark: SparkSession, path: str, files: int) -> DataFrame:
    """Pages as their files arrive, at most ``files`` of them in a micro-batch."""
    return spark.readStream.schema(PAGE).option("maxFilesPerTrigger", str(files)).parquet(path)
