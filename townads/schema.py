"""Record layouts and the fixed names of topics and series."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


AD_ITEM = _strings("ad_id", "city", "posted_date", "scraped_time")
AD_MESSAGE = _strings("ad_id", "city", "posted_date", "scraped_time", "spider")
# The typed record has one derived member besides the message fields; it is also accepted as input.
AD_RECORD = _strings("city", "ad_id", "posted_date", "scraped_time", "spider", "posted_year")
AD_PAIR = _strings("ad_id", "city")
PAGE = T.StructType([T.StructField("page_id", T.LongType()), *_strings("url", "html").fields])
METRIC_LABELS = _strings("city", "num_ads", "posted_year")

# Topic names of the input and of the two result streams.
ADS_TOPIC = "scraped-ads"
TUMBLING_TOPIC = "ads-by-city-and-year-tmbl-win"
SLIDING_TOPIC = "ads-by-city-sld-win"

# The series left visible in the chart of ads per year.
CHART_SERIES = ["2015", "2016", "2017", "2018", "2019", "2021", "2023", "2024", "Value"]
