"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as driver

QUERIES, ORACLE = driver.QUERIES, driver.ORACLE
STREAMED = [n for n in QUERIES if n.startswith("stream_") or n in ("source_stream_replay", "fanout_two_sinks")]
BATCH = [n for n in QUERIES if n not in STREAMED]


@pytest.fixture(scope="module")
def medium_con(medium):
    return connect(medium)


@pytest.fixture(scope="module")
def small_con(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", BATCH)
def test_batch(name, spark, medium, medium_con):
    assert difference(QUERIES[name](spark, medium), medium_con, ORACLE[name]) is None


@pytest.mark.parametrize("name", STREAMED)
def test_streamed(name, spark, small, small_con):
    assert difference(QUERIES[name](spark, small), small_con, ORACLE[name]) is None


def test_entry(spark):
    assert driver.entry(spark).columns == ["city", "num_ads", "posted_year", "w_start", "w_end"]
