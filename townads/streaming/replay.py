"""Replaying stored ads as a stream of messages, one span of time after the other."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from townads.functions import times, wire
from townads.schema import AD_MESSAGE
from townads.session import scratch_folder
from townads.sources.topics import read_lines

SPANS = 3


@dataclass(frozen=True)
class Parts:
    """Ads or message lines with the number of the ``part`` they arrive in, from 0."""

    rows: DataFrame
    count: int


def span_of(ads: DataFrame, spans: int = SPANS) -> Column:
    """Which of ``spans`` equally long stretches of time an ad was scraped in, from 0."""
    ts = times.event_time(F.col("scraped_time"))
    first, last = ads.agg(*(times.to_epoch_millis(f(ts)) for f in (F.min, F.max))).first()
    millis = times.to_epoch_millis(ts)
    return F.floor((millis - F.lit(first)) * F.lit(spans) / F.lit(last - first + 1)).cast("int")


def in_order(ads: DataFrame, spans: int = SPANS) -> Parts:
    """The ads by span of scrape time."""
    return Parts(ads.withColumn("part", span_of(ads, spans)), spans)


def with_held_back(ads: DataFrame, held: Column, spans: int = SPANS) -> Parts:
    """As ``in_order``, but ads for which ``held`` is TRUE arrive one span later."""
    late = F.when(held, 1).otherwise(0)
    return Parts(ads.withColumn("part", span_of(ads, spans) + late), spans + 1)


def flushed(parts: Parts) -> Parts:
    """Adds one ad far in the future to the last part, which closes all windows before it."""
    values = {
        "ad_id": "flush",
        "city": "flush",
        "posted_date": "2999-01-01",
        "scraped_time": "2999-01-01 00:00:00",
        "spider": "flush",
    }
    names = AD_MESSAGE.fieldNames()
    row = parts.rows.sparkSession.range(1).select(
        *(F.lit(values[n]).alias(n) for n in names), F.lit(parts.count - 1).alias("part")
    )
    return Parts(parts.rows.select(*names, "part").unionByName(row), parts.count)


def replay(spark: SparkSession, ads: Parts, start: Callable[[DataFrame, str], StreamingQuery]) -> str:
    """``replay_lines`` with ads instead of messages."""
    lines = ads.rows.select(wire.to_line(*AD_MESSAGE.fieldNames()).alias("value"), "part")
    return replay_lines(spark, Parts(lines, ads.count), start)


def replay_lines(spark: SparkSession, lines: Parts, start: Callable[[DataFrame, str], StreamingQuery]) -> str:
    """Delivers one part after the other and each time runs the stream up to the end of what is there.

    Every run starts from the checkpoint of the run before, as a scheduled job would. All parts are
    written in one pass first, so the source is read once. ``start`` gets the message lines and the
    folder to work in, and returns the query; the folder is returned.
    """
    folder = scratch_folder(spark, "replay")
    inbox, staged = f"{folder}/inbox", f"{folder}/staged"
    lines.rows.select("value", "part").write.partitionBy("part").text(staged)
    stage = spark.read.schema("value string, part int").text(staged)
    for part in range(lines.count):
        stage.filter(F.col("part") == part).select("value").write.mode("append").text(inbox)
        with _partition_per_core(spark):
            query = start(read_lines(spark, inbox), folder)
        query.awaitTermination()
    return folder


@contextmanager
def _partition_per_core(spark: SparkSession):
    """Streams started inside keep their state in at most as many partitions as tasks run at once.

    Each partition commits its state in each batch, which for a replay of a few batches would cost
    more than the counting. A stream copies its settings when it starts.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, before)
