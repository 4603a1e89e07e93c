"""Counts and distinct rows without windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(rows: DataFrame, keys: list[str], value: str = "ad_id") -> DataFrame:
    """Non-null values per key. On a stream: running counts, to be written in update mode."""
    return rows.groupBy(*keys).agg(F.count(value).alias("num_ads"))


def distinct(rows: DataFrame, names: list[str], within: str | None = None) -> DataFrame:
    """Distinct combinations of ``names``.

    A stream keeps every combination seen. ``within`` bounds that state: repeats are then only
    recognised up to that much event time apart, read from ``ts``.
    """
    if not rows.isStreaming:
        return rows.select(*names).distinct()
    if within is None:
        return rows.select(*names).dropDuplicates(names)
    return rows.withWatermark("ts", within).dropDuplicatesWithinWatermark(names).select(*names)
