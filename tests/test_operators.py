"""Transforms on hand-made rows, and properties that must hold on the test tables."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from townads.operators import changes, counts, crawl, ordered, rows, series, windows
from townads.__main__ import parser
from townads.plans import files, jobs
from townads.schema import AD_MESSAGE
from townads.sources import decode, jsonl, tables, topics
from townads.sources.topics import read_options, write_options
from townads.streaming import apps


def ads(spark, *records):
    """Records of (ad_id, city, scraped_time) or with a posting date as fourth."""
    full = [(r[0], r[1], r[3] if len(r) > 3 else "2022-01-01", r[2], "s") for r in records]
    return spark.createDataFrame(full, AD_MESSAGE)


def at(text):
    return dt.datetime.fromisoformat(f"2024-02-01 {text}")


def plain(df, *names):
    return sorted((tuple(r) for r in df.select(*(names or df.columns)).collect()), key=repr)


# --- cities, years, nulls ----------------------------------------------------------------------


def test_three_ways_of_no_city(spark):
    df = ads(spark, *((str(i), c, "2024-02-01 10:00:00") for i, c in enumerate([None, "", "null", "A"])))
    assert plain(rows.known_cities(df), "city") == [("",), ("A",)]
    assert plain(rows.named_cities(df), "city") == [("A",), ("null",)]


def test_null_ad_is_a_group_without_a_count(spark):
    df = ads(spark, (None, "A", "2024-02-01 10:00:00"))
    assert plain(jobs.running_counts(df)) == [("A", 0)]


def test_years(spark):
    df = ads(
        spark,
        ("1", "A", "2024-02-01 10:00:00", "2022-05-25"),
        ("2", "A", "2024-02-01 10:00:00", "202"),
        ("3", "A", "2024-02-01 10:00:00", None),
    )
    assert plain(rows.with_valid_year(df), "ad_id", "posted_year") == [("1", "2022")]
    with pytest.raises(Exception, match="no posting year in ad"):
        rows.with_valid_year(df, strict=True).collect()


def test_ad_without_a_time(spark):
    df = ads(spark, ("1", "A", "bad"), ("2", "A", "2024-02-01 10:00:00"))
    for job in (jobs.ads_by_city_and_year, jobs.ads_by_city):
        assert {r.num_ads for r in job(df).collect()} == {1}
        with pytest.raises(Exception, match="no time in ad 1"):
            job(df, strict=True).collect()


def test_not_null(spark):
    df = spark.createDataFrame([("a", "1"), (None, "2"), ("b", None)], "city string, n string")
    assert plain(rows.not_null(df, ["city", "n"])) == [("a", "1")]
    assert plain(rows.with_nulls(df, ["city", "n"]), "city") == [("b",), (None,)]
    with pytest.raises(Exception, match="NOT NULL column"):
        rows.not_null(df, ["city"], strict=True).collect()


def test_chart_series(spark):
    df = spark.createDataFrame([("2015",), ("2020",), ("Value",), (None,)], "posted_year string")
    assert plain(rows.chart_series(df)) == [("2015",), ("Value",)]
    assert plain(rows.chart_series(df, exclude=True)) == [("2020",)]


def test_recent_is_open_at_the_old_end(spark):
    df = spark.createDataFrame([(at("10:00:00"),), (at("10:00:01"),), (at("10:30:00"),), (at("10:30:01"),)], "ts timestamp_ntz")
    now = F.lit("2024-02-01 10:30:00").cast("timestamp_ntz")
    assert plain(rows.recent(df, now)) == [(at("10:00:01"),), (at("10:30:00"),)]


def test_unwrapped(spark):
    df = spark.createDataFrame([("3",), ("x",), (None,), ("2.5",)], "num_ads string")
    assert plain(rows.unwrapped(df)) == [(2.5,), (3.0,)]


# --- messages ----------------------------------------------------------------------------------

MESSAGES = [
    '{"ad_id":"1","city":null,"posted_date":"2022-01-01","scraped_time":"2024-02-01 10:00:00","spider":"s"}',
    "oops",
    '{"ad_id":"1","zzz":1}',
    '{"ad_id":7}',
    "",
    '{"ad_id":"1"',
    "[1]",
]


def messages(spark):
    return spark.createDataFrame([(m,) for m in MESSAGES], "value string")


def by_value(df, *names):
    return {r["value"]: tuple(r[n] for n in names) for r in df.collect()}


def test_typed_messages(spark):
    got = by_value(decode.decode_typed(messages(spark)), "ad_id", "city", "reason")
    assert got[MESSAGES[0]] == ("1", None, None)
    assert got[MESSAGES[2]] == ("1", "", decode.UNKNOWN_FIELD)
    assert got[MESSAGES[3]] == ("7", "", None)
    assert {got[m][2] for m in (MESSAGES[1], *MESSAGES[4:])} == {decode.BAD_JSON}


def test_declared_rows(spark):
    got = by_value(decode.decode_rows(messages(spark)), "ad_id", "city", "reason")
    assert got[MESSAGES[0]] == ("1", None, None)
    assert got[MESSAGES[2]] == ("1", None, None)
    assert got[MESSAGES[3]] == ("7", None, None)
    assert {got[m][2] for m in (MESSAGES[1], *MESSAGES[4:])} == {decode.BAD_JSON}


def test_coerced_messages(spark):
    got = by_value(decode.decode_coerced(messages(spark)), "ad_id", "city", "reason")
    assert got[MESSAGES[0]] == ("1", "", None)
    assert got[MESSAGES[2]] == ("1", "", None)


def test_times_get_reasons(spark):
    checked = by_value(decode.check_times(decode.decode_typed(messages(spark))), "reason")
    assert checked[MESSAGES[0]] == (None,)
    assert checked[MESSAGES[3]] == (decode.BAD_TIME,)


def test_good_and_quarantined_are_everything(spark, small):
    lines = tables.messages(spark, small)
    checked = decode.check_times(decode.decode_typed(lines))
    assert decode.good(checked).count() + decode.quarantined(checked).count() == lines.count()


def test_strict_messages(spark):
    with pytest.raises(Exception, match="rejected message: bad json: oops"):
        decode.strict(decode.decode_rows(messages(spark).filter("value = 'oops'"))).collect()


def test_topic_options():
    assert read_options("b:1", ["x", "y"], "g", maxOffsetsPerTrigger="5") == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "x,y",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "5",
    }
    assert write_options("b:1", "t") == {"kafka.bootstrap.servers": "b:1", "topic": "t"}


def test_labels_of_a_topic_without_year(spark):
    sliding = jobs.ads_by_city(ads(spark, ("1", "A", "2024-02-01 10:00:00")))
    records = topics.as_topic(sliding, "t", jobs._sliding_fields(), F.col("window_end"))
    lines = topics.with_labels(records, group="g")
    assert plain(lines.limit(1), "topic", "group", "num_ads", "posted_year") == [("t", "g", "1", None)]


def test_jsonl_elements(spark):
    assert plain(jsonl.from_elements(spark, [("1", "A")])) == [("1", "A")]


# --- windows -----------------------------------------------------------------------------------


def test_window_edge(spark):
    df = ads(spark, ("1", "A", "2024-02-01 10:05:00"), ("2", "A", "2024-02-01 10:04:59"))
    assert plain(jobs.ads_by_city_and_year(df), "num_ads", "w_start", "w_end") == [
        (1, at("10:00:00"), at("10:05:00")),
        (1, at("10:05:00"), at("10:10:00")),
    ]


def test_sliding_copies(spark):
    df = rows.with_event_time(ads(spark, ("1", "A", "2024-02-01 10:00:05")))
    assigned = windows.assign(df, "60 seconds", "10 seconds")
    starts = [r.window_start for r in assigned.orderBy("window_start").collect()]
    assert starts == [at("10:00:00") - dt.timedelta(seconds=10 * k) for k in range(5, -1, -1)]


@pytest.mark.parametrize("size, slide", [("60 seconds", "10 seconds"), ("5 seconds", "2 seconds"), ("7 minutes", "3 minutes")])
def test_shared_panes_give_the_direct_result(spark, medium, size, slide):
    timed = rows.with_event_time(tables.ads(spark, medium))
    one, two = (
        windows.sliding_counts(timed, ["city", "posted_date"], size, slide, shared=s) for s in (True, False)
    )
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_tumbling_sums_to_the_plain_count(spark, medium):
    timed = rows.with_event_time(tables.ads(spark, medium))
    summed = series.totals(windows.tumbling_counts(timed, ["city"], "300 seconds"), ["city"])
    assert plain(summed) == plain(counts.count_by(timed, ["city"]))


@pytest.mark.parametrize("gap", ["10 seconds", "5 minutes", "2 hours"])
def test_sessions_equal_the_built_in_ones(spark, medium, gap):
    timed = rows.with_event_time(tables.ads(spark, medium))
    ours = windows.session_counts(timed, ["city"], gap)
    w = F.session_window("ts", gap).alias("w")
    built_in = timed.groupBy("city", w).agg(F.count("ad_id").alias("num_ads")).select(
        "city", "num_ads", F.col("w.start").alias("w_start"), F.col("w.end").alias("w_end")
    )
    assert ours.exceptAll(built_in).isEmpty() and built_in.exceptAll(ours).isEmpty()


def test_sessions_that_touch_are_one(spark):
    df = rows.with_event_time(
        ads(
            spark,
            ("1", "A", "2024-02-01 10:00:00"),
            ("2", "A", "2024-02-01 10:00:10"),
            ("3", "A", "2024-02-01 10:00:21"),
        )
    )
    assert plain(windows.session_counts(df, ["city"], "10 seconds")) == [
        ("A", 1, at("10:00:21"), at("10:00:31")),
        ("A", 2, at("10:00:00"), at("10:00:20")),
    ]


def test_top_k_ties_by_name(spark):
    df = ads(spark, *((str(i), c, "2024-02-01 10:00:00") for i, c in enumerate("BACAB")))
    assert plain(jobs.top_cities(df, k=2), "rank", "city", "num_ads") == [(1, "A", 2), (2, "B", 2)]


@pytest.mark.parametrize("size", ["five seconds", "1 month", "", "0 seconds"])
def test_window_size_must_be_a_literal(spark, small, size):
    with pytest.raises(ValueError):
        windows.tumbling_counts(rows.with_event_time(tables.ads(spark, small)), ["city"], size)


def test_windows_on_the_posting_day(spark):
    df = ads(spark, ("1", "A", "2024-02-01 10:00:00", "2022-05-25"), ("2", "A", "2024-02-01 10:00:00", "2022-02-31"))
    assert plain(jobs.ads_by_posting_day(df), "num_ads", "w_start") == [(1, dt.datetime(2022, 5, 25))]


def test_distinct(spark):
    df = ads(spark, *(("1", "A", "2024-02-01 10:00:00"),) * 3, ("1", None, "2024-02-01 10:00:00"))
    assert plain(jobs.distinct_ads(df)) == [("A", "1")]


# --- changes -----------------------------------------------------------------------------------


def test_changes_of_a_key_that_starts_without_an_ad(spark):
    df = rows.with_event_time(
        ads(
            spark,
            (None, "A", "2024-02-01 10:00:00"),
            ("1", "A", "2024-02-01 10:00:01"),
            (None, "A", "2024-02-01 10:00:02"),
            ("2", None, "2024-02-01 10:00:00"),
        )
    )
    got = [tuple(r) for r in changes.count_changes(df).orderBy("city", "seq").select("city", "op", "num_ads").collect()]
    assert got == [(None, "INSERT", 1), ("A", "INSERT", 0), ("A", "DELETE", 0), ("A", "INSERT", 1)]


@pytest.mark.parametrize("slices", [1, 7])
def test_changes_fold_to_the_counts(spark, medium, slices):
    timed = rows.with_event_time(tables.ads(spark, medium))
    folded = changes.folded(changes.count_changes(timed, slices=slices))
    assert plain(folded) == plain(counts.count_by(timed, ["city"]))


def test_a_hot_key_is_spread_over_slices(spark):
    """Two thirds of the rows are copies of one row, yet no slice holds more than its share."""
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 != 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("city"),
        F.lit("2024-02-01 10:00:00").cast("timestamp_ntz").alias("ts"),
        F.lit("1").alias("ad_id"),
    )
    sizes = [r["count"] for r in ordered.sliced(df, ["city"], ["ts", "ad_id"], 8).groupBy("slice").count().collect()]
    assert len(sizes) == 8 and sum(sizes) == n and max(sizes) < 2 * n / 8
    numbered = ordered.numbered(df, ["city"], ["ts", "ad_id"], "ad_id", 8).filter("city = 'hot'")
    top, distinct = numbered.agg(F.max("row_no"), F.count_distinct("value_no")).first()
    assert top == distinct == n * 2 // 3


def test_envelope(spark):
    df = spark.createDataFrame([("A", None)], "city string, ad_id string")
    line = changes.as_inserts(df).first().value
    assert json.loads(line) == {"data": [{"city": "A", "ad_id": None}], "type": "INSERT"}


# --- roll-ups ----------------------------------------------------------------------------------


def samples(spark, *records):
    return spark.createDataFrame([(c, float(n), at(t)) for c, n, t in records], "city string, num_ads double, ts timestamp_ntz")


def test_range_includes_its_end_only(spark):
    df = samples(spark, ("A", 1, "10:00:00"), ("A", 2, "10:00:01"), ("A", 4, "10:30:00"), ("A", 8, "10:30:01"))
    assert plain(series.sum_over_time(df, ["city"], "30 minutes")) == [
        ("A", at("10:00:00"), 1.0),
        ("A", at("10:30:00"), 6.0),
        ("A", at("11:00:00"), 8.0),
    ]


def test_last_over_time(spark):
    df = samples(spark, ("A", 5, "10:00:10"), ("A", 1, "10:00:20"), ("A", 2, "10:00:20"), ("A", 7, "10:01:00"))
    assert plain(series.last_over_time(df, ["city"], "1 minute", "30 seconds")) == [
        ("A", at("10:00:30"), 2.0),
        ("A", at("10:01:00"), 7.0),
        ("A", at("10:01:30"), 7.0),
    ]


def test_last_not_null(spark):
    df = spark.createDataFrame([("A", 1.0, 1), ("A", None, 2), ("B", None, 1)], "city string, num_ads double, step int")
    assert plain(series.last_not_null(df, ["city"])) == [("A", 1.0)]


def test_cumulative_ends_at_the_total(spark, medium):
    result = jobs.ads_by_city_and_year(tables.ads(spark, medium))
    ends = series.cumulative(result, ["city"]).groupBy("city").agg(F.max("total").alias("num_ads"))
    assert plain(ends) == plain(series.totals(result, ["city"]))


# --- pages -------------------------------------------------------------------------------------


def page(url, *parts):
    return (1, url, "".join(parts))


CITY = '<a href="/city/haifa" class="btn ps-2">x</a>'


@pytest.mark.parametrize(
    "record, expected",
    [
        (page("https://x/ad/5", CITY, '<div class="px-3">p: 25/05/2022</div>'), [("5", "haifa", "2022-05-25")]),
        (page("https://x/ad/5", CITY), [("5", "haifa", None)]),
        (page("https://x/ad/5", CITY, '<div class="px-3">soon</div>'), []),
        (page("https://x/list", CITY), []),
        (page("https://x/ad/5", '<a href="/city/" class="ps-2">x</a>'), []),
        (page("https://x/ad/5", "no link"), []),
        (page(None, CITY), []),
        (page("https://x/ad/5", None or ""), []),
    ],
)
def test_page_gives_at_most_one_ad(spark, record, expected):
    pages = spark.createDataFrame([record], "page_id long, url string, html string")
    found = crawl.extract_ads(pages, F.lit("2024-02-01 12:30:00").cast("timestamp_ntz"))
    assert plain(found, "ad_id", "city", "posted_date") == expected
    if expected:
        assert found.first().scraped_time == "2024-02-01 12:30:00"


def test_frontier(spark):
    pages = spark.createDataFrame(
        [
            (1, "http://h.org/", '<a href="/b#x">1</a><a href="/c?b=1&amp;a=2">2</a><a href="mailto:q@h.org">3</a>'),
            (2, "http://h.org/b", '<a href="http://h.org/c?a=2&amp;b=1">4</a><a href="http://o.com/">5</a>'),
        ],
        "page_id long, url string, html string",
    )
    links = crawl.in_domains(crawl.extract_links(pages), ["h.org"])
    assert plain(crawl.frontier(links, pages)) == [("http://h.org/c?a=2&b=1",)]


def test_base_of_links(spark):
    pages = spark.createDataFrame(
        [(1, "http://h.org/a", '<base href="/z/"><a href="q">1</a><a href="x.pdf">2</a>')], "page_id long, url string, html string"
    )
    links = crawl.extract_links(pages)
    assert plain(links, "url") == [("http://h.org/z/q",), ("http://h.org/z/x.pdf",)]
    assert plain(crawl.in_domains(links, ["h.org"]), "url") == [("http://h.org/z/q",)]


def test_file_job_sets_unusable_ads_apart(spark, tmp_path):
    times = ("2024-02-01 10:00:00", "2024-02-01T10:00:00.5", "junk")
    df = ads(spark, *((str(i), "A", t) for i, t in enumerate(times)))
    jsonl.write_ads(df, f"{tmp_path}/in")
    with pytest.raises(Exception, match="no time in ad 2"):
        files.run(spark, "count-by-city-sliding", f"{tmp_path}/in", f"{tmp_path}/out")
    files.run(spark, "count-by-city-sliding", f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/bad")
    assert [r.ad_id for r in jsonl.read_ads(spark, f"{tmp_path}/bad").collect()] == ["2"]
    lines = [r.value for r in spark.read.text(f"{tmp_path}/out").collect()]
    assert lines and all('"num_ads":2' in line or '"num_ads":1' in line for line in lines)


def test_live_options():
    read = apps.live_options("b:1", "ads", "sliding-result", 500)
    assert read["maxOffsetsPerTrigger"] == "500" and read["kafka.group.id"] == "sliding-result"
    args = parser().parse_args(["tumbling", "--servers", "b:1", "--checkpoint", "c", "--max-records", "7", "--every", "1 minute"])
    assert (args.max_records, args.every) == (7, "1 minute")
