"""Sessions of hot keys, change logs as deltas, messages sent again, character references."""

from __future__ import annotations

import datetime as dt
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from townads.functions import html
from townads.operators import windows
from townads.sources import topics
from townads.streaming import runs

START = dt.datetime(2024, 1, 1)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


# --- sessions ----------------------------------------------------------------------------------


def _sessions(data, gap):
    by, out = defaultdict(list), []
    for city, ts, ad in data:
        by[city].append((ts, ad))
    for city, found in by.items():
        found.sort(key=lambda x: x[0])
        open_ = None
        for ts, ad in found:
            if open_ and ts <= open_[2] + gap:
                open_ = (open_[0] + (ad is not None), open_[1], ts)
            else:
                if open_:
                    out.append((city, open_[0], open_[1], open_[2] + gap))
                open_ = (int(ad is not None), ts, ts)
        out.append((city, open_[0], open_[1], open_[2] + gap))
    return sorted(out, key=repr)


@pytest.mark.parametrize("slices", [1, 2, 5, 4096])
def test_sessions_over_slices(spark, monkeypatch, slices):
    """One key over many slices: sessions within one, over two, and over many of them."""
    monkeypatch.setattr(windows, "SLICE_GAPS", slices)
    draw = random.Random(slices)
    data, ts = [], START
    for _ in range(400):
        ts += dt.timedelta(seconds=draw.choice([0, 1, 30, 59, 60, 61, 200, 900]))
        data.append((draw.choice(["hot", "hot", "hot", None, "b"]), ts, draw.choice(["x", "x", None])))
    data += [("long", START + dt.timedelta(seconds=50 * i), "x") for i in range(100)]  # one session over all slices
    data += [("touch", START, "x"), ("touch", START + dt.timedelta(seconds=60), "x"), ("touch", START + dt.timedelta(seconds=121), "x")]
    frame = spark.createDataFrame(data, "city string, ts timestamp_ntz, ad_id string").repartition(3)
    got = windows.session_counts(frame, ["city"], "60 seconds")
    assert rows(got) == _sessions(data, dt.timedelta(seconds=60))


# --- change logs -------------------------------------------------------------------------------


def _batches(seed, n=11):
    draw = random.Random(seed)
    return [[(draw.choice(["a", "b", "c", None]), draw.choice(["1", None])) for _ in range(draw.randrange(0, 5))] for _ in range(n)]


def _expected_changes(batches):
    counts, out = {}, []
    for number, batch in enumerate(batches):
        new = defaultdict(int)
        for city, ad in batch:
            new[city] += ad is not None
        for city, n in new.items():
            before = counts.get(city)
            if before is None or n:
                out += [(number, city, "DELETE", before)] if before is not None else []
                out.append((number, city, "INSERT", (before or 0) + n))
            counts[city] = (before or 0) + n
    return sorted(out, key=repr)


@pytest.mark.parametrize("merge_every", [1, 3, 32])
def test_change_log_writes_touched_keys_and_can_be_repeated(spark, tmp_path, merge_every):
    batches = _batches(merge_every)
    write = runs.count_changes(str(tmp_path / "out"), str(tmp_path / "state"), merge_every=merge_every)

    def frame(n):
        return spark.createDataFrame(batches[n], "city string, ad_id string")

    for n in range(len(batches)):
        write(frame(n), n)
        if n % 3 == 0:  # it failed after writing and is run again
            write(frame(n), n)
    got = spark.read.parquet(str(tmp_path / "out")).select("batch", "city", "op", "num_ads")
    assert rows(got) == _expected_changes(batches)
    for n, batch in enumerate(batches):
        touched = spark.read.schema("city string, num_ads long").parquet(str(tmp_path / "state" / "touched" / str(n)))
        assert {r.city for r in touched.collect()} == {city for city, _ in batch}
    merges = tmp_path / "state" / "all"
    assert (sorted(map(int, os.listdir(merges))) if merges.exists() else []) == list(range(merge_every, len(batches), merge_every))


# --- distinct rows by a table -------------------------------------------------------------------


@pytest.mark.parametrize("merge_every", [2, 3, 32])
def test_first_seen_rows_come_once_and_can_be_repeated(spark, tmp_path, merge_every):
    draw = random.Random(merge_every)
    city = lambda: draw.choice(["a", "b", "", None])
    batches = [[(city(), draw.choice([None, *"123456789"])) for _ in range(6)] for _ in range(10)]
    batches[4] = []
    write = runs.first_seen(str(tmp_path / "out"), str(tmp_path / "seen"), ["city", "ad_id"], 8, merge_every)
    seen, expected = set(), []
    for n, batch in enumerate(batches):
        frame = spark.createDataFrame([(*row, n) for row in batch], "city string, ad_id string, more int")
        write(frame, n)
        if n % 3 == 1:  # it failed after writing and is run again
            write(frame, n)
        expected += [(n, *row) for row in set(batch) - seen]
        seen |= set(batch)
    got = spark.read.parquet(str(tmp_path / "out")).select("batch", "city", "ad_id")
    assert rows(got) == sorted(expected, key=repr)
    merged = tmp_path / "seen" / "_level=1"
    assert (len(os.listdir(merged)) if merged.exists() else 0) == 9 // merge_every


def test_first_seen_reads_only_the_buckets_it_meets(spark, tmp_path):
    write = runs.first_seen(str(tmp_path / "out"), str(tmp_path / "seen"), ["ad_id"], buckets=16)
    write(spark.range(400).select(F.col("id").cast("string").alias("ad_id")), 0)
    one = spark.createDataFrame([("7",), ("400",)], "ad_id string")
    met = {r[0] for r in one.select(F.pmod(F.xxhash64("ad_id"), F.lit(16))).collect()}
    # A batch that read another bucket would fail on its file.
    for folder in (tmp_path / "seen" / "_level=0" / "_number=0").glob("_bucket=*"):
        if int(folder.name.split("=")[1]) not in met:
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"no parquet")
            for check in folder.glob(".*.crc"):
                check.unlink()
    write(one, 1)
    assert rows(spark.read.parquet(str(tmp_path / "out" / "batch=1"))) == [("400",)]


@pytest.mark.parametrize("merge_every", [2, 3, 10])
def test_spans_hold_every_batch_once(merge_every):
    for batches in range(120):
        held = [
            n for level, i in runs._spans(batches, merge_every)
            for n in range(i * merge_every**level, (i + 1) * merge_every**level)
        ]
        assert held == list(range(batches))


# --- messages sent again ------------------------------------------------------------------------


def test_messages_sent_again_are_read_once(spark, tmp_path):
    send = runs.send_to_log(str(tmp_path / "log"))

    def frame(*values):
        return spark.createDataFrame([(v,) for v in values], "value string").repartition(3)

    send(frame("a", "b", "b"), 0)
    send(frame("a", "b"), 1)  # a part of batch 1 before it failed
    send(frame("a", "b", "c", "b"), 1)
    send(frame("a", "b", "b"), 0)
    records = topics.read_log(spark, str(tmp_path / "log"))
    assert [r[0] for r in rows(topics.first_of_each(records).select("value"))] == ["a", "a", "b", "b", "b", "b", "c"]


def test_records_without_a_key_stay(spark):
    records = spark.createDataFrame([(None, "x"), (None, "x"), ("k", "y"), ("k", "y")], "message_key string, value string")
    assert [r[1] for r in rows(topics.first_of_each(records))] == ["y", "x", "x"]


def test_a_stream_forgets_keys_after_a_while(spark, tmp_path):
    with pytest.raises(ValueError, match="remembered"):
        topics.first_of_each(spark.readStream.format("rate").load().withColumn("message_key", F.lit("k")))
    schema = "message_key string, value string, ts timestamp"
    data = [("k", "a", START), ("k", "a", START), (None, "b", START), (None, "b", START), ("l", "c", START)]
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "in"))
    once = topics.first_of_each(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "1 hour")
    runs.to_table(once.select("value"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert [r[0] for r in rows(spark.read.parquet(str(tmp_path / "out")))] == ["a", "b", "b", "c"]


# --- character references -----------------------------------------------------------------------


def test_references_in_links(spark):
    page = (
        '<a href="/a&amp;b?x=1&amp;y=2">x</a><a href="&#x2F;hex">x</a><a href="&#47;dec">x</a><a href=/q&quot;r>x</a>'
        '<a href="/u&#x6570;&#233;&#128512;">x</a><a href="/bad&#xD800;&#0;&#99999999;&none;&amp">x</a>'
        '<a href="/twice&amp;amp;">x</a><a href="/a&b;c&lt;d">x</a>'
    )
    frame = spark.createDataFrame([(page,), ("<p>none</p>",), (None,)], "html string")
    got = [r[0] for r in frame.select(html.links(F.col("html"))).collect()]
    assert got == [
        ["/a&b?x=1&y=2", "/hex", "/dec", '/q"r', "/u数é😀", "/bad&#xD800;&#0;&#99999999;&none;&amp", "/twice&amp;", "/a&b;c<d"],
        [],
        None,
    ]


def test_references_in_classes(spark):
    page = '<a class="btn ps&#45;2" href="/city/haifa&#x20;bay">x</a>'
    frame = spark.createDataFrame([(page,)], "html string")
    found = html.first_attribute(F.col("html"), "a", "ps-2", "href")
    assert frame.select(found).first()[0] == "/city/haifa bay"
