"""Column functions on hand-made values."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from townads.functions import html, times, urls, wire


def values(spark, function, *inputs):
    """``function`` applied to each input; a tuple gives several arguments."""
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(inputs)]
    width = len(rows[0]) - 1
    names = [f"c{i}" for i in range(width)]
    df = spark.createDataFrame(rows, "i int, " + ", ".join(f"{n} string" for n in names))
    out = df.select("i", function(*(F.col(n) for n in names)).alias("v")).collect()
    return [r.v for r in sorted(out)]


def test_event_time(spark):
    got = values(
        spark,
        times.event_time,
        "2024-02-01 12:30:00",
        "bad",
        None,
        "2024-02-30 00:00:00",
        "2024-02-01T12:30:00",
        "2024",
        "2024-02-01 12:30:00.25",
    )
    noon = dt.datetime(2024, 2, 1, 12, 30)
    assert got == [noon, None, None, None, noon, None, noon.replace(microsecond=250000)]


def test_noon_is_twelve(spark):
    got = values(spark, lambda c: F.hour(times.event_time(c)), "2024-02-01 12:30:00", "2024-02-01 00:30:00")
    assert got == [12, 0]


def test_epoch_round_trip(spark):
    millis = values(
        spark,
        lambda c: times.to_epoch_millis(times.iso_time(c)),
        "2024-02-01 12:30:00",
        "1970-01-01 00:00:01.999",
        "1969-12-31 23:59:58.5",
        "no",
    )
    assert millis == [1706790600000, 1999, -1500, None]
    back = values(spark, lambda c: times.from_epoch_millis(c.cast("long")), "1706790600999", "-1500", None)
    assert back == [dt.datetime(2024, 2, 1, 12, 30), dt.datetime(1969, 12, 31, 23, 59, 59), None]


def test_posted_year(spark):
    assert values(spark, times.posted_year, "2022-05-25", "202", None) == ["2022", "202", None]
    assert values(spark, times.has_year, "2022", "202", None, "20x2", "20221") == [True, False, False, True, False]


@pytest.mark.parametrize(
    "text, date",
    [
        (">x: 25/05/2022", "2022-05-25"),
        ("25-05-2022", "2022-05-25"),
        ("on  5/05/2022", "2022-05-05"),
        ("5/5/2022", "2022-05-05"),
        ("25/5/2022", "2022-05-25"),
        ("25/13/2022", None),
        ("31/02/2022", None),
        ("25/05/2022 ", None),
        ("junk", None),
        ("", None),
        (None, None),
    ],
)
def test_posted_date(spark, text, date):
    assert values(spark, times.posted_date, text) == [date]


def test_durations():
    assert [times.seconds(d) for d in ("300 seconds", "1 minute", " 2 hours ", "1 day")] == [300, 60, 7200, 86400]
    for wrong in ("0 seconds", "-5 seconds", "1 month", "five minutes", "", None, 300, "1.5 hours"):
        with pytest.raises(ValueError):
            times.seconds(wrong)


def test_url_parts(spark):
    assert values(spark, urls.ad_id_from_url, "https://x/ad/12/ad/99", "https://x/ad/7", "https://x/") == [
        "99",
        "7",
        "https://x/",
    ]
    assert values(spark, urls.is_ad_url, "https://x/ad/1", "https://x/ads/1", None) == [True, False, None]
    assert values(spark, urls.city_from_link, "haifa", "https://x/city/", None, "/a/b") == ["haifa", "", None, "b"]


def test_domains(spark):
    got = values(
        spark,
        lambda c: urls.in_domain(c, "example.com"),
        "https://example.com/a",
        "http://m.example.com:80?x",
        "https://u:p@WWW.Example.com#f",
        "https://notexample.com/",
        "https://example.com.evil.org/",
        "https://evil.org/example.com",
    )
    assert got == [True, True, True, False, False, False]


@pytest.mark.parametrize(
    "link, url",
    [
        ("https://o.org/x", "https://o.org/x"),
        ("mailto:a@b", "mailto:a@b"),
        ("//cdn.org/x", "https://cdn.org/x"),
        ("/x", "https://h.org/x"),
        ("x", "https://h.org/a/x"),
        ("?q=2", "https://h.org/a/b?q=2"),
        ("#top", "https://h.org/a/b?q=1#top"),
        ("", "https://h.org/a/b?q=1"),
    ],
)
def test_absolute(spark, link, url):
    assert values(spark, urls.absolute, (link, "https://h.org/a/b?q=1#f")) == [url]


def test_absolute_without_path(spark):
    assert values(spark, urls.absolute, ("x", "https://h.org")) == ["https://h.org/x"]


def test_request_key(spark):
    got = values(spark, urls.request_key, "http://h/p?b=2&a=1#f", "http://h/p?a=1&b=2", "http://h/p", "http://h/p#f")
    assert got[0] == got[1] == "http://h/p?a=1&b=2"
    assert got[2] == got[3] == "http://h/p"
    same = ["http://h.org/a/../b", "HTTP://H.org:80/b", "http://h.org/./b#x", "http://h.org/../b"]
    assert values(spark, urls.request_key, *same) == ["http://h.org/b"] * 4
    plain = values(spark, urls.request_key, "http://h.org", "https://h.org:443/a/..", "mailto:A@b", "http://h.org/A/.?q=/../")
    assert plain == ["http://h.org/", "https://h.org/", "mailto:A@b", "http://h.org/A/?q=/../"]


def test_is_page(spark):
    got = values(spark, urls.is_page, "http://h.org/x.PDF?q", "http://h.org/x.html", "http://h.zip", "http://h.org/x?f=a.pdf")
    assert got == [False, True, True, True]


def test_class_token(spark):
    page = """<a class="ps-20" href="/no">n</a><a class='ps-2'>no href</a>
        <A HREF=/bare class="btn ps-2 x">y</A><a class="ps-2" href="/late">z</a>"""
    city = lambda c: html.first_attribute(html.visible(c), "a", "ps-2", "href")
    assert values(spark, city, page, "<a class='x ps-2' href='/a&amp;b'>", '<a class="ps-2-x" href="/n">', "") == [
        "/bare",
        "/a&b",
        None,
        None,
    ]


def test_hidden_markup_is_skipped(spark):
    page = """<!-- <a class="ps-2" href="/c1">x</a> --><script>'<a class="ps-2" href="/c2">'</script>
        <a class="ps-2" title="a > b" href="/c3">x</a>"""
    city = lambda c: html.first_attribute(html.visible(c), "a", "ps-2", "href")
    assert values(spark, city, page) == ["/c3"]


def test_first_text(spark):
    text = lambda c: html.first_text(c, "div", "px-3")
    got = values(
        spark,
        text,
        '<div class="a px-3"><b>skip</b></div><div class="px-3">one</div><div class="px-3">two</div>',
        '<div>class="px-3"</div>',
        '<div class="px-30">no</div>',
    )
    assert got == ["one", None, None]


def test_tag_that_never_closes(spark):
    page = "<a " + "x" * 50000 + '<div class="px-3">t</div>' + "<a href='y" * 2000
    assert values(spark, lambda c: html.first_text(c, "div", "px-3"), page) == ["t"]
    assert values(spark, html.links, page) is not None


def test_links(spark):
    page = """<a href=" /a ">1</a><area href='/b'><a name="x">no</a><a href="/a">again</a><link href="/css">"""
    assert values(spark, html.links, page) == [["/a", "/b"]]


def test_wire_times(spark):
    t = lambda z: lambda c: wire.wire_time(c.cast("timestamp_ntz"), z)
    assert values(spark, t(False), "2024-02-01 10:00:00", "2024-02-01 10:00:00.120") == [
        "2024-02-01 10:00:00",
        "2024-02-01 10:00:00.12",
    ]
    assert values(spark, t(True), "2024-02-01 10:00:00") == ["2024-02-01 10:00:00Z"]


def test_wire_times_in_another_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Jerusalem")
    try:
        plain = spark.sql("SELECT timestamp_ntz '2024-03-29 02:30:00.5' AS t, timestamp '2024-02-01 08:00:00Z' AS z")
        sent = plain.select(wire.wire_time(F.col("t")), wire.wire_time(F.col("t"), True), wire.wire_time(F.col("z"), True))
        assert tuple(sent.first()) == ("2024-03-29 02:30:00.5", "2024-03-29 02:30:00.5Z", "2024-02-01 08:00:00Z")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_attributes_inside_others(spark):
    city = lambda c: html.first_attribute(html.visible(c), "a", "ps-2", "href")
    page = "<a title='go href=wrong x' class='ps-2' href='/city/right'>"
    other = "<a title='a class=ps-2 b' href='/city/wrong'><a href=\"/city/next\" class=ps-2>"
    assert values(spark, city, page, other) == ["/city/right", "/city/next"]


def test_lines_keep_nulls(spark):
    line = lambda a, b: wire.to_line(a.alias("a"), b.alias("b"))
    assert values(spark, line, ("x", None), ('q"', "שלום")) == ['{"a":"x","b":null}', '{"a":"q\\"","b":"שלום"}']
    change = lambda a: wire.change_line(F.lit("DELETE"), a.alias("a"))
    assert values(spark, change, "x") == ['{"data":[{"a":"x"}],"type":"DELETE"}']
