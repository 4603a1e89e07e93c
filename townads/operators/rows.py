"""Row-wise transforms: projections, derived columns, filters, null checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townads.functions import times
from townads.schema import CHART_SERIES


def with_event_time(
    ads: DataFrame, source: str = "scraped_time", zoned: bool = False, strict: bool = False
) -> DataFrame:
    """Adds ``ts``. Batch plans keep it zone-less; watermarks need the zoned form.

    An ad without a readable time gets NULL and falls in no window; ``strict`` fails the job.
    """
    ts = times.event_time(F.col(source))
    if strict:
        failure = F.raise_error(F.concat(F.lit("no time in ad "), F.coalesce("ad_id", F.lit("?"))))
        ts = F.coalesce(ts, failure.cast("timestamp_ntz"))
    return ads.withColumn("ts", ts.cast("timestamp") if zoned else ts)


def with_posting_time(ads: DataFrame, strict: bool = False) -> DataFrame:
    """Adds ``ts`` taken from the posting date. An ad without a readable date gets NULL and falls in no
    window; ``strict`` fails the job."""
    ts = times.posting_day(F.col("posted_date"))
    if strict:
        failure = F.raise_error(F.concat(F.lit("no posting date in ad "), F.coalesce("ad_id", F.lit("?"))))
        ts = F.coalesce(ts, failure.cast("timestamp_ntz"))
    return ads.withColumn("ts", ts)


def with_posted_year(ads: DataFrame) -> DataFrame:
    return ads.withColumn("posted_year", times.posted_year(F.col("posted_date")))


def with_valid_year(ads: DataFrame, strict: bool = False) -> DataFrame:
    """Adds ``posted_year``, the first four characters of the posting date whatever they are; ads with
    fewer are left out, or fail the job when ``strict``."""
    dated = with_posted_year(ads)
    valid = times.has_year(F.col("posted_year"))
    if strict:
        failure = F.raise_error(F.concat(F.lit("no posting year in ad "), F.coalesce("ad_id", F.lit("?"))))
        return dated.filter(F.when(valid, F.lit(True)).otherwise(failure.cast("boolean")))
    return dated.filter(valid)


def with_spider(ads: DataFrame, name: str) -> DataFrame:
    return ads.withColumn("spider", F.lit(name))


def known_cities(rows: DataFrame) -> DataFrame:
    """Drops NULL and the text 'null'; keeps the empty city."""
    return rows.filter(F.col("city") != "null")


def named_cities(rows: DataFrame) -> DataFrame:
    """Drops NULL and the empty city; keeps the text 'null'."""
    return rows.filter(F.col("city") != "")


def chart_series(rows: DataFrame, names: list[str] = CHART_SERIES, exclude: bool = False) -> DataFrame:
    listed = F.col("posted_year").isin(names)
    return rows.filter(~listed if exclude else listed)


def recent(rows: DataFrame, now: Column, span: str = "30 minutes", time_col: str = "ts") -> DataFrame:
    """Rows of the ``span`` before ``now``."""
    start = now - F.make_dt_interval(secs=F.lit(times.seconds(span)))
    return rows.filter((F.col(time_col) > start) & (F.col(time_col) <= now))


def unwrapped(rows: DataFrame, name: str = "num_ads") -> DataFrame:
    """Turns a text label into a number and drops rows where that fails."""
    return rows.withColumn(name, F.col(name).try_cast("double")).filter(F.col(name).isNotNull())


def not_null(rows: DataFrame, names: list[str], strict: bool = False) -> DataFrame:
    """Keeps rows without a NULL in ``names``; ``strict`` fails the job on the first other row."""
    complete = F.lit(True)
    for name in names:
        complete = complete & F.col(name).isNotNull()
    if strict:
        failure = F.raise_error(F.lit("NULL in a NOT NULL column of: " + ", ".join(names)))
        complete = F.when(complete, F.lit(True)).otherwise(failure.cast("boolean"))
    return rows.filter(complete)


def with_nulls(rows: DataFrame, names: list[str]) -> DataFrame:
    """The rows that ``not_null`` leaves out."""
    missing = F.lit(False)
    for name in names:
        missing = missing | F.col(name).isNull()
    return rows.filter(missing)
