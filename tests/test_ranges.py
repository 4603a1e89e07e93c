"""Crawl levels, ads by day, long ranges: hand-made cases against plain versions, and plans."""

from __future__ import annotations

import datetime as dt
import random
import re
from collections import defaultdict, deque

import pytest
from pyspark.sql import functions as F

from townads.operators import crawl, levels, rows, series
from townads.plans import jobs
from townads.schema import SLIDING_TOPIC, TUMBLING_TOPIC
from townads.sources import daily, decode, tables, topics
from townads.streaming import apps

START = dt.datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimised(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


# --- crawl order -------------------------------------------------------------------------------


def _distances(edges, roots):
    follow = defaultdict(set)
    for a, b in edges:
        follow[a].add(b)
    found, queue = {r: 0 for r in roots}, deque(roots)
    while queue:
        at = queue.popleft()
        for b in follow[at] - found.keys():
            found[b] = found[at] + 1
            queue.append(b)
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_levels_are_least_distances(spark, seed):
    draw = random.Random(seed)
    names = [f"n{i}" for i in range(60)]
    edges = [(draw.choice(names), draw.choice(names)) for _ in range(90)]
    edges += [("n0", "n1"), ("n1", "n2"), ("n2", "n0"), ("n5", "n5")]  # a cycle and a page that links to itself
    edges += [(f"c{i}", f"c{i + 1}") for i in range(12)] + [("n0", "c0")]  # a chain
    roots = ["n0", "n7"]
    got = levels.levels(
        spark.createDataFrame(edges, "source string, target string"),
        spark.createDataFrame([(r,) for r in roots * 2], "url string"),
    )
    assert {tuple(r) for r in got.collect()} == set(_distances(edges, roots).items())
    assert got.count() == len(_distances(edges, roots))


def test_levels_without_roots_or_links(spark):
    none = spark.createDataFrame([], "source string, target string")
    assert levels.levels(none, spark.createDataFrame([], "url string")).count() == 0
    assert [tuple(r) for r in levels.levels(none, spark.createDataFrame([("a",)], "url string")).collect()] == [("a", 0)]


def test_crawl_meets_spellings_cycles_and_lone_pages(spark):
    def page(n, url, *links):
        return n, url, "".join(f'<a href="{link}">x</a>' for link in links)

    pages = spark.createDataFrame(
        [
            page(1, "https://a.example.com/", "/one", "HTTPS://A.example.com:443/x/../two#top", "https://other.org/"),
            page(2, "https://a.example.com/one", "/", "/three?b=1&a=2", "/missing"),
            page(3, "https://a.example.com/two", "/two", "one"),
            page(4, "https://a.example.com/three?a=2&b=1", "/four"),
            page(5, "https://a.example.com/four"),
            page(6, "https://a.example.com/lone", "/"),
            page(7, "https://other.org/", "https://a.example.com/lone"),
            page(8, "https://a.example.com/one", "/four"),  # the same page again, with another link
            (9, None, None),
        ],
        "page_id long, url string, html string",
    )
    got = levels.crawl_levels(pages, ["https://A.example.com/", "https://a.example.com/gone"], ["example.com"])
    assert {(r.url.removeprefix("https://a.example.com"), r.level) for r in got.collect()} == {
        ("/", 0), ("/one", 1), ("/two", 1), ("/three?a=2&b=1", 2), ("/four", 2),
    }


def test_links_are_made_once(spark, small):
    pages = tables.ad_pages(spark, small)
    links = crawl.in_domains(crawl.extract_links(pages), ["example.com"])
    for result, scans in ((links, 1), (crawl.frontier(links, pages), 1)):
        text = optimised(result)
        # One search for start tags of links, one for base tags, one for the attributes of each.
        assert text.count("regexp_extract_all(") <= 4 * scans
        assert text.count("<!--") == scans


# --- ads by day --------------------------------------------------------------------------------


def test_a_range_reads_only_its_days(spark, small, tmp_path):
    path = str(tmp_path / "ads")
    ads = tables.ads(spark, small)
    odd = spark.createDataFrame([("x", "c", "2024-01-01", "no time", "s"), ("y", "c", None, None, "s")], ads.schema)
    daily.write_ads(ads.union(odd), path)
    stored = daily.read_ads(spark, path)
    assert sorted(map(tuple, stored.drop(daily.DAY).collect()), key=repr) == sorted(map(tuple, ads.union(odd).collect()), key=repr)
    now = F.lit("2024-01-20 00:10:00").cast("timestamp_ntz")
    recent = jobs.recent_ads_by_city(stored, now)
    text = plan(recent)
    assert re.search(r"PartitionFilters: \[.*scraped_day#\d+ >= 2024-01-19.*scraped_day#\d+ <= 2024-01-20", text)
    assert sorted(map(tuple, recent.collect())) == sorted(map(tuple, jobs.recent_ads_by_city(ads, now).collect()))
    # Of 30 days and one for ads without a time, two are read.
    days = {r[0] for r in daily.between(stored, F.lit("2024-01-19 23:39:00"), now).select(F.input_file_name()).distinct().collect()}
    assert {re.search(r"scraped_day=([^/]*)", d).group(1) for d in days} <= {"2024-01-19", "2024-01-20"}


def test_added_ads_and_the_newest_day(spark, tmp_path):
    path = str(tmp_path / "ads")
    schema = "ad_id string, city string, posted_date string, scraped_time string, spider string"

    def ads(*times):
        return spark.createDataFrame([(t, "c", "2024-01-01", t, "s") for t in times], schema)

    daily.write_ads(ads("2024-01-01 10:00:00", "2024-01-02 10:00:00"), path)
    daily.write_ads(ads("2024-01-02T23:59:59.5", "2023-12-31 00:00:00"), path)
    stored = daily.read_ads(spark, path)
    assert stored.count() == 4
    assert {r.ad_id for r in daily.newest(stored).collect()} == {"2024-01-02 10:00:00", "2024-01-02T23:59:59.5"}


# --- ranges over time --------------------------------------------------------------------------


def _samples(spark, seed, n=120, spread=4000):
    draw = random.Random(seed)
    data = [
        (
            draw.choice(["a", "b", None]),
            START + dt.timedelta(seconds=draw.randrange(spread), microseconds=draw.choice([0, 0, 1, 999_999])),
            draw.choice([None, 0.0, 1.0, 2.0, 5.0]),
        )
        for _ in range(n)
    ]
    data += [("a", START, 3.0), ("a", START, 4.0), ("a", None, 9.0), ("late", START + dt.timedelta(days=400), 1.0)]
    return data, spark.createDataFrame(data, "city string, ts timestamp_ntz, num_ads double")


def _expected(data, span, step, pick):
    offset, out = span % step, {}
    seen = defaultdict(list)
    for city, ts, v in data:
        if ts is None:
            continue
        micros = (ts - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
        t = -((offset * 1_000_000 - micros) // (step * 1_000_000)) * step * 1_000_000 + offset * 1_000_000
        t = t if t >= micros else t + step * 1_000_000
        while t - step * 1_000_000 >= micros:
            t -= step * 1_000_000
        while t < micros + span * 1_000_000:
            seen[city, t].append((micros, v))
            t += step * 1_000_000
    for (city, t), found in seen.items():
        out[city, dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=t)] = pick(found)
    return out


def _sum(found):
    known = [v for _, v in found if v is not None]
    return sum(known) if known else None


def _last(found):
    return max(found, key=lambda x: (x[0], x[1] is not None, x[1] or 0))[1]


@pytest.mark.parametrize("span,step", [(600, 10), (605, 10), (3600, 7), (1000, 20)])
def test_long_sums(spark, monkeypatch, span, step):
    monkeypatch.setattr(series, "SEGMENT", 16)  # a label's steps lie in many segments
    data, samples = _samples(spark, span)
    got = series.sum_over_time(samples, ["city"], f"{span} seconds", f"{step} seconds")
    assert {(r.city, r.step): r.num_ads for r in got.collect()} == _expected(data, span, step, _sum)
    assert got.count() == len(_expected(data, span, step, _sum))


@pytest.mark.parametrize("span,step", [(60, 60), (600, 10), (605, 10), (30, 60), (1000, 20)])
def test_last_values(spark, monkeypatch, span, step):
    monkeypatch.setattr(series, "SEGMENT", 4)
    data, samples = _samples(spark, span)
    got = series.last_over_time(samples, ["city"], f"{span} seconds", f"{step} seconds")
    assert {(r.city, r.step): r.num_ads for r in got.collect()} == _expected(data, span, step, _last)
    assert got.count() == len(_expected(data, span, step, _last))


def test_direct_and_difference_sums_agree(spark, monkeypatch):
    _, samples = _samples(spark, 5)
    direct = series.sum_over_time(samples, ["city"], "150 seconds", "10 seconds")
    monkeypatch.setattr(series, "MOST_COPIES", 1)
    differences = series.sum_over_time(samples, ["city"], "150 seconds", "10 seconds")
    assert "Expand" in plan(direct) and "Expand" not in plan(differences)
    assert sorted(map(tuple, direct.collect()), key=repr) == sorted(map(tuple, differences.collect()), key=repr)


def test_long_ranges_copy_no_sample_to_all_its_steps(spark, small):
    records = jobs.result_topics(tables.ads(spark, small))
    sums = series.sum_over_time(topics.samples(records, TUMBLING_TOPIC), ["city"], "1 hour", "10 seconds")
    text = plan(sums)
    assert "Expand" not in text and "SortAggregate" not in text
    # What is generated before the differences are summed are the two rows of a sample.
    assert re.search(r"HashAggregate\(keys=\[city[^]]*at[^]]*\], functions=\[partial_sum", text)
    assert len(re.findall(r"Generate inline\(array\(struct\(at", text)) >= 1
    last = series.last_over_time(topics.samples(records, SLIDING_TOPIC), ["city"], "1 hour", "10 seconds")
    for result in (last, series.last_not_null(last, ["city"])):
        assert "SortAggregate" not in plan(result) and "Expand" not in plan(result).split("from_json")[0]


def test_newest_value_of_a_series(spark):
    _, samples = _samples(spark, 9)
    got = {r.city: r.num_ads for r in series.last_not_null(samples.where("ts IS NOT NULL"), ["city"], "ts").collect()}
    expected = {}
    for r in sorted(samples.where("num_ads IS NOT NULL AND ts IS NOT NULL").collect(), key=lambda r: (r.ts, r.num_ads)):
        expected[r.city] = r.num_ads
    assert got == expected


def test_recent_rows_keep_their_shape(spark, small, tmp_path):
    path = str(tmp_path / "ads")
    daily.write_ads(tables.ads(spark, small), path)
    assert rows.known_cities(daily.newest(daily.read_ads(spark, path))).columns[-1] == daily.DAY


# --- nothing is lost unseen ---------------------------------------------------------------------


def test_nested_values_are_refused(spark):
    lines = [
        '{"ad_id":{"x":1},"city":"c","posted_date":"2024-01-01","scraped_time":"2024-01-01 00:00:00"}',
        '{"ad_id":"1","city":["c"],"posted_date":"2024-01-01","scraped_time":"2024-01-01 00:00:00"}',
        '{"ad_id":"{not an object}","city":"[c]","posted_date":"2024-01-01","scraped_time":"2024-01-01 00:00:00"}',
        '{"ad_id":7,"city":null,"posted_date":"2024-01-01","scraped_time":"2024-01-01 00:00:00"}',
    ]
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    assert [r.reason for r in decode.decode_typed(frame).collect()] == ["nested value", "nested value", None, None]


def test_posting_days_that_are_no_dates(spark):
    ads = spark.createDataFrame(
        [("1", "c", "2024-02-30", "2024-01-01 00:00:00", "s"), ("2", "c", "2024-02-28", "2024-01-01 00:00:00", "s")],
        "ad_id string, city string, posted_date string, scraped_time string, spider string",
    )
    assert [r.num_ads for r in jobs.ads_by_posting_day(ads).collect()] == [1]
    with pytest.raises(Exception, match="no posting date in ad 1"):
        jobs.ads_by_posting_day(ads, strict=True).collect()
    told = decode.check_times(ads.withColumns({"value": F.col("ad_id"), "reason": F.lit(None).cast("string")}), posting_day=True)
    assert {r.value: r.reason for r in told.collect()} == {"1": "bad posted_date", "2": None}


@pytest.mark.parametrize("job", [jobs.ads_per_session, jobs.top_cities, jobs.ads_by_city_sql, jobs.city_windows])
def test_strict_jobs_fail_on_ads_without_a_time(spark, job):
    ads = spark.createDataFrame([("1", "c", "2024-02-28", "never", "s")], "ad_id string, city string, posted_date string, scraped_time string, spider string")
    assert job(ads).count() == 0
    with pytest.raises(Exception, match="no time in ad 1"):
        job(ads, strict=True).collect()


def test_live_jobs_say_where_bad_messages_go(spark):
    with pytest.raises(ValueError, match="quarantine"):
        apps.start_live(spark, "sliding", "broker:9092", "/nowhere")
