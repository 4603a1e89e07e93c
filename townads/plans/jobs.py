"""The counting jobs. Each takes ads as a batch or a stream and returns its result rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townads.functions import times, wire
from townads.functions.times import seconds
from townads.operators import counts, rows, windows
from townads.schema import SLIDING_TOPIC, TUMBLING_TOPIC
from townads.session import LATENESS
from townads.sources import daily, topics

# Window lengths of the jobs and the lateness the uneven one tolerates.
TUMBLING_SIZE = "300 seconds"
SLIDING_SIZE, SLIDING_STEP = "60 seconds", "10 seconds"
HOURLY_SIZE = "1 hour"
UNEVEN_SIZE, UNEVEN_STEP, UNEVEN_LATENESS = "5 seconds", "2 seconds", "3 seconds"

_SLIDING_BOUNDS = ("window_start", "window_end")


def timed(ads: DataFrame, lateness: str, strict: bool = False) -> DataFrame:
    """Adds ``ts``; on a stream also the watermark."""
    if not ads.isStreaming:
        return rows.with_event_time(ads, strict=strict)
    return rows.with_event_time(ads, zoned=True, strict=strict).withWatermark("ts", lateness)


def ads_by_city_and_year(
    ads: DataFrame, size: str = TUMBLING_SIZE, lateness: str = LATENESS, strict: bool = False
) -> DataFrame:
    """Ads per city and posting year in tumbling windows, without the empty city.

    ``lateness='0 seconds'`` expects times that never go back.
    """
    dated = rows.with_valid_year(timed(ads, lateness, strict), strict)
    found = windows.tumbling_counts(dated, ["city", "posted_year"], size)
    return rows.named_cities(found).select("city", "num_ads", "posted_year", "w_start", "w_end")


def ads_by_city(
    ads: DataFrame, lateness: str = LATENESS, shared: bool | None = None, strict: bool = False
) -> DataFrame:
    """Ads per city over the last minute, every ten seconds, without the city 'null'."""
    known = rows.known_cities(timed(ads, lateness, strict))
    found = windows.sliding_counts(
        known, ["city"], SLIDING_SIZE, SLIDING_STEP, bounds=_SLIDING_BOUNDS, shared=shared
    )
    return found.select("city", "num_ads", *_SLIDING_BOUNDS)


def recent_ads_by_city(ads: DataFrame, now: Column, span: str = "30 minutes") -> DataFrame:
    """``ads_by_city`` for the windows that ended in the ``span`` before ``now``. Batch only.

    Ads too old to be in such a window are dropped before they are counted; of a table by scrape day the
    folders of other days are not read.
    """
    reach = seconds(span) + seconds(SLIDING_SIZE)
    # Text of one form sorts as time does, and a bound on it reaches the scan; the exact filter follows.
    # A day of slack covers the form with a T, which sorts after the other one of the same day.
    oldest, newest = now - F.make_dt_interval(secs=F.lit(reach)), now + F.make_dt_interval(days=F.lit(1))
    text = F.col("scraped_time")
    near = ads.filter((text >= times.stamp(oldest)) & (text < times.stamp(newest)))
    if daily.DAY in ads.columns:
        near = daily.between(near, oldest, now).drop(daily.DAY)
    counted = rows.recent(rows.with_event_time(near), now, f"{reach} seconds")
    return rows.recent(ads_by_city(counted.drop("ts")), now, span, "window_end")


def ads_by_city_sql(ads: DataFrame, lateness: str = LATENESS, strict: bool = False) -> DataFrame:
    """``ads_by_city`` written as SQL text."""
    return ads.sparkSession.sql(
        f"""
        SELECT city, num_ads, w.start AS window_start, w.end AS window_end
        FROM (
            SELECT city, count(ad_id) AS num_ads, window(ts, '{SLIDING_SIZE}', '{SLIDING_STEP}') AS w
            FROM {{source}}
            WHERE city <> 'null'
            GROUP BY city, window(ts, '{SLIDING_SIZE}', '{SLIDING_STEP}')
        )
        """,
        source=timed(ads, lateness, strict),
    )


def ads_by_city_hourly(ads: DataFrame, lateness: str = LATENESS, strict: bool = False) -> DataFrame:
    """Ads per city over the last hour, every ten seconds: 360 windows for each ad, so counted in panes."""
    known = rows.known_cities(timed(ads, lateness, strict))
    return windows.sliding_counts(known, ["city"], HOURLY_SIZE, SLIDING_STEP, bounds=_SLIDING_BOUNDS)


def ads_by_city_uneven(ads: DataFrame, strict: bool = False) -> DataFrame:
    """Windows of five seconds every two, so that neighbours overlap by parts of a step."""
    known = rows.known_cities(timed(ads, UNEVEN_LATENESS, strict))
    return windows.sliding_counts(known, ["city"], UNEVEN_SIZE, UNEVEN_STEP)


def ads_by_posting_day(
    ads: DataFrame, size: str = "1 day", lateness: str | None = None, strict: bool = False
) -> DataFrame:
    """The tumbling job on the day an ad was posted instead of the time it was scraped.

    Posting days come in no order, so a stream counts every ad however old: write it in update mode; its
    state has one row per city, year and day. A ``lateness`` bounds that state and allows append mode,
    but then ads posted earlier than that before the newest one are not counted. Ads whose date cannot be read are
    in no window; ``strict`` fails on them, and ``decode.check_times(..., posting_day=True)`` sets them apart.
    """
    posted = rows.with_posting_time(rows.with_valid_year(ads, strict), strict)
    if ads.isStreaming:
        posted = posted.withColumn("ts", F.col("ts").cast("timestamp"))
        posted = posted.withWatermark("ts", lateness) if lateness else posted
    found = windows.tumbling_counts(posted, ["city", "posted_year"], size)
    return rows.named_cities(found).select("city", "num_ads", "posted_year", "w_start", "w_end")


def ads_per_session(
    ads: DataFrame, gap: str = "30 minutes", lateness: str = LATENESS, strict: bool = False
) -> DataFrame:
    known = rows.known_cities(timed(ads, lateness, strict))
    return windows.session_counts(known, ["city"], gap)


def top_cities(ads: DataFrame, k: int = 3, size: str = "1 hour", strict: bool = False) -> DataFrame:
    """The cities with most ads in each window. Batch; ``streaming.runs.top_k`` is the stream form."""
    return windows.top_k(city_windows(ads, size, strict=strict), k)


def city_windows(
    ads: DataFrame, size: str = "1 hour", lateness: str = LATENESS, strict: bool = False
) -> DataFrame:
    return windows.tumbling_counts(rows.known_cities(timed(ads, lateness, strict)), ["city"], size)


def running_counts(ads: DataFrame) -> DataFrame:
    return rows.known_cities(counts.count_by(ads, ["city"]))


def distinct_ads(ads: DataFrame, within: str | None = None) -> DataFrame:
    # The filter comes first: a stream would remember for ever what it then drops.
    return counts.distinct(rows.known_cities(ads), ["city", "ad_id"], within)


def tumbling_messages(result: DataFrame) -> DataFrame:
    """Result rows of the tumbling job as JSON lines, positions and names as its topic has them."""
    return result.select(wire.to_line(*_tumbling_fields()).alias("value"))


def sliding_messages(result: DataFrame) -> DataFrame:
    """Result rows of the sliding job as JSON lines; its times carry a zone."""
    return result.select(wire.to_line(*_sliding_fields()).alias("value"))


def windowed_text(result: DataFrame) -> DataFrame:
    """Windowed counts with their bounds as zoned text."""
    bounds = [wire.wire_time(F.col(c), zoned=True).alias(c) for c in ("w_start", "w_end")]
    return result.select("city", "num_ads", *bounds)


def _tumbling_fields() -> list:
    bounds = [wire.wire_time(F.col(c)).alias(c) for c in ("w_start", "w_end")]
    return [F.col("city"), F.col("num_ads"), F.col("posted_year"), *bounds]


def _sliding_fields() -> list:
    bounds = [wire.wire_time(F.col(c), zoned=True).alias(c) for c in _SLIDING_BOUNDS]
    return [F.col("city"), F.col("num_ads"), *bounds]


def result_topics(ads: DataFrame) -> DataFrame:
    """Records of both result streams, timed by the end of their window."""
    tumbling = topics.as_topic(
        ads_by_city_and_year(ads), TUMBLING_TOPIC, _tumbling_fields(), F.col("w_end")
    )
    sliding = topics.as_topic(ads_by_city(ads), SLIDING_TOPIC, _sliding_fields(), F.col("window_end"))
    return tumbling.unionByName(sliding)
