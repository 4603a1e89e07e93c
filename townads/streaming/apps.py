"""The live jobs, from topic to topic."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from townads.operators import crawl
from townads.plans import jobs
from townads.schema import ADS_TOPIC, SLIDING_TOPIC, TUMBLING_TOPIC
from townads.sources import decode, topics
from townads.streaming import runs

# A first micro-batch from the earliest offset is no larger than any other.
MAX_RECORDS = 1_000_000
EVERY = "10 seconds"
FILES = 100  # of pages in a micro-batch
SPIDER = "stored-pages"

# Name of a live job: its result topic, how it reads messages, what it computes and sends.
LIVE = {
    "tumbling": (TUMBLING_TOPIC, True, jobs.ads_by_city_and_year, jobs.tumbling_messages),
    "sliding": (SLIDING_TOPIC, False, jobs.ads_by_city, jobs.sliding_messages),
    "sliding-sql": (SLIDING_TOPIC, False, jobs.ads_by_city_sql, jobs.sliding_messages),
}


def result_messages(name: str, records: DataFrame, strict: bool = False) -> DataFrame:
    """The messages a live job sends for the records of its input topic."""
    _, typed, count, encode = LIVE[name]
    return encode(count(runs.ads_from_lines(records.select("value"), typed, strict)))


def rejected(name: str, records: DataFrame) -> DataFrame:
    """The messages a live job cannot use, with the reason."""
    return decode.quarantined(runs.decoded(records.select("value"), LIVE[name][1]))


def start_live(
    spark: SparkSession,
    name: str,
    servers: str,
    checkpoint: str,
    *,
    source: str = ADS_TOPIC,
    target: str | None = None,
    quarantine: str | None = None,
    strict: bool = False,
    max_records: int = MAX_RECORDS,
    every: str = EVERY,
    read: Callable[[str], DataFrame] | None = None,
) -> list[StreamingQuery]:
    """Starts a live job and the query that fills the ``quarantine`` folder with messages it cannot use.

    A ``strict`` job fails on such a message instead; one of the two has to be chosen, so none is lost unseen.
    Windows close in append mode, so both cannot share one sink; each query reads the topic with a
    consumer group of its own, at most ``max_records`` records in a micro-batch.
    """
    if not (strict or quarantine):
        raise ValueError("name a quarantine folder for messages that cannot be used, or choose strict")
    topic = target or LIVE[name][0]
    if read is None:
        def read(purpose: str) -> DataFrame:
            return topics.read_topics(spark, live_options(servers, source, f"{topic}-{purpose}", max_records))

    started = [
        topics.write_topic(
            result_messages(name, read("result"), strict),
            topics.write_options(servers, topic),
            f"{checkpoint}/result",
            every=every,
        )
    ]
    if not strict:
        bad = rejected(name, read("quarantine")).writeStream.option("checkpointLocation", f"{checkpoint}/quarantine")
        started.append(bad.trigger(processingTime=every).format("parquet").start(quarantine))
    return started


def start_ingest(
    pages: DataFrame,
    items: str,
    checkpoint: str,
    send: runs.BatchWriter,
    spider: str = SPIDER,
    scraped: Column | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Turns stored pages, as they arrive, into ads: to a JSONL folder and, with the spider's name, to a topic.

    ``scraped`` is the time given to the ads, by default that of the micro-batch. Without ``every`` the
    query handles the pages that are there and ends.
    """
    ads = crawl.extract_ads(pages, F.current_timestamp() if scraped is None else scraped)
    return runs.to_batches(ads, runs.fan_out(items, send, spider), checkpoint, every=every)


def live_options(servers: str, source: str, group: str, max_records: int) -> dict:
    return topics.read_options(servers, [source], group, maxOffsetsPerTrigger=str(max_records))


def await_all(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Waits until one of the queries ends; the others are stopped then, and its failure is raised."""
    spark.streams.resetTerminated()  # of queries that ended before
    try:
        while all(query.isActive for query in queries):
            spark.streams.awaitAnyTermination(5)
    finally:
        ended = [query for query in queries if not query.isActive]
        for query in queries:
            if query.isActive:
                query.stop()
    for query in ended:
        query.awaitTermination()  # raises what it failed with
