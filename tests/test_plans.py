"""What the physical plans must look like to hold up on large tables."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from townads.operators import changes, crawl, rows
from townads.plans import jobs
from townads.sources import decode, tables, topics
from townads.schema import TUMBLING_TOPIC

QUERIES = driver.QUERIES
BATCH = [n for n in QUERIES if not n.startswith("stream_") and n not in ("source_stream_replay", "fanout_two_sinks")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, small, tmp_path_factory):
    """Ads as a table, so that filters and columns can reach the scan."""
    path = str(tmp_path_factory.mktemp("ads") / "ads")
    tables.ads(spark, small).write.parquet(path)
    return spark.read.parquet(path)


def scan(text):
    return re.search(r"PushedFilters: \[(.*?)\], ReadSchema: struct<(.*?)>", text).groups()


@pytest.mark.parametrize("shared", [True, False])
def test_sliding_reads_three_columns_and_filters_in_the_scan(stored, shared):
    pushed, read = scan(plan(jobs.ads_by_city(stored, shared=shared)))
    assert "Not(EqualTo(city,null))" in pushed and "IsNotNull(city)" in pushed
    assert read == "ad_id:string,city:string,scraped_time:string"


def test_filter_after_the_aggregate_reaches_the_scan(stored):
    pushed, read = scan(plan(jobs.ads_by_city_and_year(stored)))
    assert "Not(EqualTo(city,))" in pushed
    assert "spider" not in read


def test_plain_count_reads_two_columns(stored):
    assert scan(plan(jobs.running_counts(stored)))[1] == "ad_id:string,city:string"


def test_counts_are_combined_before_the_shuffle(stored):
    for df in (jobs.ads_by_city_and_year(stored), jobs.ads_by_city(stored), jobs.running_counts(stored)):
        assert "partial_count" in plan(df)


def test_top_k_is_cut_before_the_shuffle(stored):
    assert re.search(r"WindowGroupLimit .* Partial", plan(jobs.top_cities(stored)))


def test_changes_shuffle_the_rows_once_after_slicing(spark, stored):
    """With the join not broadcast: one exchange of rows, three of totals."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(changes.count_changes(rows.with_event_time(stored)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 4


def test_messages_are_parsed_once(spark, small):
    lines = tables.messages(spark, small)
    for read in (decode.decode_typed, decode.decode_rows, decode.decode_coerced):
        assert plan(decode.good(decode.check_times(read(lines)))).count("from_json") == 1
    records = jobs.result_topics(tables.ads(spark, small))
    assert plan(topics.samples(records, TUMBLING_TOPIC)).count("from_json") == 1


def test_recent_range_reaches_the_scan(spark, stored):
    now = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        pushed, _ = scan(plan(jobs.recent_ads_by_city(stored, now)))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(scraped_time,2024-01-20 11:29:00)" in pushed
    assert "LessThan(scraped_time,2024-01-21 12:00:00)" in pushed


def test_one_topic_of_two_computes_one_job(spark, small):
    text = plan(topics.samples(jobs.result_topics(tables.ads(spark, small)), TUMBLING_TOPIC))
    assert text.count("FileScan") == 1 and "Union" not in text


def test_pages_are_searched_once(spark, small):
    found = crawl.extract_ads(tables.ad_pages(spark, small), F.lit("2024-02-01").cast("timestamp_ntz"))
    assert plan(found).count("<!--") == 1


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_nested_loops(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text
