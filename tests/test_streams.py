"""Streams: late rows, restarts, failures, sinks that are written again."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from townads import __main__ as cli
from townads.operators import changes, rows
from townads.plans import files, jobs
from townads.session import scratch_folder
from townads.sources import jsonl, tables, topics
from townads.streaming import apps, replay, runs

# Five parts of (ad_id, city, time of day), one micro-batch each.
SCRIPT = [
    [("1", "A", "10:00:10"), ("2", "A", "10:04:59"), ("3", "null", "10:01:00")],
    [("4", "A", "10:05:04"), ("5", "A", "10:04:58")],
    [("6", "A", "10:04:57"), ("7", "A", "10:05:05")],
    [("8", "A", "10:04:56"), ("9", "B", "10:06:00")],
    [("1", "A", "10:06:01")],
]


def line(ad_id, city, time):
    return json.dumps(
        {"ad_id": ad_id, "city": city, "posted_date": "2022-01-01", "scraped_time": f"2024-02-01 {time}", "spider": "s"}
    )


@pytest.fixture(scope="module")
def inbox(tmp_path_factory):
    """One file per part, oldest first."""
    import os

    folder = tmp_path_factory.mktemp("inbox")
    for i, part in enumerate(SCRIPT):
        file = folder / f"part{i}.json"
        file.write_text("".join(line(*ad) + "\n" for ad in part))
        os.utime(file, (1700000000 + 10 * i,) * 2)
    return str(folder)


def script_ads(spark, inbox):
    return runs.ads_from_lines(topics.read_lines(spark, inbox, maxFilesPerTrigger="1"))


def finish(query):
    query.awaitTermination()
    return query


def plain(df, *names):
    return sorted((tuple(r) for r in df.select(*(names or df.columns)).collect()), key=repr)


def at(text):
    return dt.datetime.fromisoformat(f"2024-02-01 {text}")


def test_late_rows_of_the_script(spark, inbox, tmp_path):
    timed = jobs.timed(script_ads(spark, inbox), "5 seconds")
    result = rows.known_cities(jobs.windows.tumbling_counts(timed, ["city"], jobs.TUMBLING_SIZE))
    finish(runs.to_table(result, f"{tmp_path}/out", f"{tmp_path}/cp"))
    got = plain(spark.read.parquet(f"{tmp_path}/out"))
    assert got == [("A", 5, at("10:00:00"), at("10:05:00"))]


def test_distinct_of_the_script(spark, inbox, tmp_path):
    pairs = jobs.counts.distinct(script_ads(spark, inbox), ["city", "ad_id"])
    finish(runs.to_table(pairs, f"{tmp_path}/out", f"{tmp_path}/cp"))
    got = plain(spark.read.parquet(f"{tmp_path}/out"))
    assert len(got) == 9 and got.count(("A", "1")) == 1


def test_distinct_remembers_only_what_it_returns(spark, inbox, tmp_path):
    query = runs.to_table(jobs.distinct_ads(script_ads(spark, inbox)), f"{tmp_path}/out", f"{tmp_path}/cp")
    finish(query)
    kept = query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    assert kept == spark.read.parquet(f"{tmp_path}/out").count() == 8


def test_a_failing_query_ends_the_job(spark, inbox, tmp_path):
    def fail(batch, batch_id):
        raise ValueError("side query")

    lines = topics.read_lines(spark, inbox)
    ends = runs.to_batches(lines, fail, f"{tmp_path}/a", every="1 second")
    lasts = runs.to_batches(lines, runs.write_parquet(f"{tmp_path}/out"), f"{tmp_path}/b", every="1 hour")
    with pytest.raises(Exception, match="side query"):
        apps.await_all(spark, [lasts, ends])
    assert not lasts.isActive
    spark.streams.resetTerminated()


def test_distinct_with_bounded_state(spark, inbox, tmp_path):
    timed = rows.with_event_time(script_ads(spark, inbox), zoned=True)
    finish(runs.to_table(jobs.distinct_ads(timed, "5 seconds"), f"{tmp_path}/out", f"{tmp_path}/cp"))
    got = plain(spark.read.parquet(f"{tmp_path}/out"))
    assert got.count(("A", "1")) == 2


def test_running_counts_of_the_script(spark, inbox, tmp_path):
    running = jobs.counts.count_by(script_ads(spark, inbox), ["city"])
    finish(runs.to_batches(running, runs.write_parquet(f"{tmp_path}/out"), f"{tmp_path}/cp", "update"))
    got = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").orderBy("batch", "city").select("batch", "city", "num_ads").collect()]
    assert got == [(0, "A", 2), (0, "null", 1), (1, "A", 4), (2, "A", 6), (3, "A", 7), (3, "B", 1), (4, "A", 8)]


EXPECTED_CHANGES = [
    (0, "A", "INSERT", 2),
    (0, "null", "INSERT", 1),
    (1, "A", "DELETE", 2),
    (1, "A", "INSERT", 4),
    (2, "A", "DELETE", 4),
    (2, "A", "INSERT", 6),
    (3, "A", "DELETE", 6),
    (3, "A", "INSERT", 7),
    (3, "B", "INSERT", 1),
    (4, "A", "DELETE", 7),
    (4, "A", "INSERT", 8),
]


def read_changes(spark, path):
    got = spark.read.parquet(path).orderBy("batch", "city", "op").select("batch", "city", "op", "num_ads")
    return [tuple(r) for r in got.collect()]


def test_changes_of_the_script(spark, inbox, tmp_path):
    write = runs.count_changes(f"{tmp_path}/out", f"{tmp_path}/counts")
    finish(runs.to_batches(script_ads(spark, inbox), write, f"{tmp_path}/cp"))
    assert read_changes(spark, f"{tmp_path}/out") == EXPECTED_CHANGES


def test_changes_after_a_failed_batch(spark, inbox, tmp_path):
    """A batch that fails after it has written is repeated and leaves the same changes."""
    inner = runs.count_changes(f"{tmp_path}/out", f"{tmp_path}/counts")
    failed = []

    def write(batch, batch_id):
        inner(batch, batch_id)
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost")

    with pytest.raises(Exception):
        finish(runs.to_batches(script_ads(spark, inbox), write, f"{tmp_path}/cp"))
    assert failed == [2]
    finish(runs.to_batches(script_ads(spark, inbox), write, f"{tmp_path}/cp"))
    assert read_changes(spark, f"{tmp_path}/out") == EXPECTED_CHANGES


def test_changes_keep_a_null_key_apart(spark, tmp_path):
    write = runs.count_changes(f"{tmp_path}/out", f"{tmp_path}/counts")
    for i, cities in enumerate([[None, "A"], [None, None], ["A"]]):
        write(spark.createDataFrame([(c, "1") for c in cities], "city string, ad_id string"), i)
    assert sorted(read_changes(spark, f"{tmp_path}/out"), key=repr) == sorted(
        [
            (0, None, "INSERT", 1),
            (0, "A", "INSERT", 1),
            (1, None, "DELETE", 1),
            (1, None, "INSERT", 3),
            (2, "A", "DELETE", 1),
            (2, "A", "INSERT", 2),
        ],
        key=repr,
    )


def test_failed_fan_out_is_repeated_whole(spark, inbox, tmp_path):
    failed = []
    send = runs.send_to_files(f"{tmp_path}/topic")

    def failing(batch, batch_id):
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost")
        send(batch, batch_id)

    def start():
        write = runs.fan_out(f"{tmp_path}/items", failing, "crawler")
        return runs.to_batches(script_ads(spark, inbox).drop("spider"), write, f"{tmp_path}/cp")

    with pytest.raises(Exception):
        finish(start())
    finish(start())
    items = jsonl.read_ads(spark, f"{tmp_path}/items")
    sent = runs.ads_from_lines(topics.read_lines(spark, f"{tmp_path}/topic", streaming=False))
    assert items.count() == sent.count() == 10
    assert plain(sent.select("spider").distinct()) == [("crawler",)]


def test_stopped_stream_goes_on_where_it_was(spark, small):
    ads = tables.ads(spark, small)
    parts = replay.flushed(replay.in_order(ads))
    offsets = []

    def start(lines, folder):
        query = runs.to_table(jobs.ads_by_city_and_year(runs.ads_from_lines(lines)), f"{folder}/out", f"{folder}/cp")
        query.awaitTermination()
        offsets.append(sum(p["numInputRows"] for p in query.recentProgress))
        return query

    folder = replay.replay(spark, parts, start)
    assert sum(offsets) == ads.count() + 1 and all(offsets)
    assert spark.read.parquet(f"{folder}/out").count() == jobs.ads_by_city_and_year(ads).count()


def test_quarantine_and_good_are_everything(spark, small):
    lines = tables.messages(spark, small)

    def start(stream, folder):
        write = runs.set_apart(runs.write_parquet(f"{folder}/good"), f"{folder}/bad")
        return runs.to_batches(stream, write, f"{folder}/cp")

    folder = replay.replay_lines(spark, replay.Parts(lines.withColumn("part", F.lit(0)), 1), start)
    good, bad = (spark.read.parquet(f"{folder}/{n}").count() for n in ("good", "bad"))
    assert good and bad and good + bad == lines.count()


@pytest.mark.parametrize("name", list(apps.LIVE))
def test_live_messages(spark, inbox, tmp_path, name):
    records = topics.read_lines(spark, inbox, maxFilesPerTrigger="1")
    out = apps.result_messages(name, records)
    query = out.writeStream.format("text").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True)
    finish(query.start(f"{tmp_path}/out"))
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/out").collect()]
    if name == "tumbling":
        assert {
            "city": "A",
            "num_ads": 5,
            "posted_year": "2022",
            "w_start": "2024-02-01 10:00:00",
            "w_end": "2024-02-01 10:05:00",
        } in lines
    else:
        assert {l["city"] for l in lines} == {"A"}
        assert all(l["window_end"].endswith("Z") for l in lines)


def test_strict_stream_fails(spark, tmp_path):
    folder = scratch_folder(spark, "bad")
    spark.createDataFrame([("oops",)], "value string").write.text(folder)
    ads = runs.ads_from_lines(topics.read_lines(spark, folder), strict=True)
    with pytest.raises(Exception, match="rejected message"):
        finish(runs.to_table(ads, f"{tmp_path}/out", f"{tmp_path}/cp"))


def test_rejected_messages(spark):
    bad = spark.createDataFrame([("oops",), (line("1", "A", "10:00:00"),)], "value string")
    assert plain(apps.rejected("tumbling", bad)) == [("oops", "bad json")]


# --- command line ------------------------------------------------------------------------------


@pytest.mark.parametrize("name", list(files.FILE_JOBS))
def test_file_jobs(spark, tmp_path, name):
    source = tmp_path / "items.jsonl"
    ads = [ad for part in SCRIPT for ad in part]
    source.write_text("".join(line(*ad) + "\n" for ad in ads))
    files.run(spark, name, str(source), f"{tmp_path}/out")
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/out").collect()]
    kinds = {l["type"] for l in lines}
    data = [l["data"][0] for l in lines]
    if name == "pass-through":
        assert len(lines) == 10 and kinds == {"INSERT"}
    elif name == "filter-null-cities":
        assert len(lines) == 9 and all(d["city"] != "null" for d in data)
    elif name == "dedup":
        assert len(lines) == 8
    elif name == "count-by-city":
        assert kinds == {"INSERT", "DELETE"} and len(lines) == 2 * 9 - 2
        written = [json.loads(t) for f in sorted((tmp_path / "out").glob("part-*")) for t in f.read_text().splitlines()]
        of_a = [(r["type"], r["data"][0]["num_ads"]) for r in written if r["data"][0]["city"] == "A"]
        assert of_a == [("INSERT", 1)] + [c for n in range(2, 9) for c in (("DELETE", n - 1), ("INSERT", n))]
    else:
        assert all(set(d) == {"city", "num_ads", "w_start", "w_end"} for d in data)


@pytest.mark.parametrize("name", list(files.FILE_JOBS))
def test_file_jobs_fail_on_a_bad_line(spark, tmp_path, name):
    (tmp_path / "items.jsonl").write_text(line("1", "A", "10:00:10") + "\noops\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.run(spark, name, f"{tmp_path}/items.jsonl", f"{tmp_path}/out")


def test_arguments():
    args = cli.parser().parse_args(["tumbling", "--servers", "b:1", "--checkpoint", "/c"])
    assert (args.source, args.target, args.strict) == ("scraped-ads", "ads-by-city-and-year-tmbl-win", False)
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["count-by-city", "--input", "x"])
