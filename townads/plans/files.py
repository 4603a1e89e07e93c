"""The jobs over a JSONL file of ads, each writing change lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from townads.functions import times
from townads.operators import changes, rows
from townads.plans import jobs
from townads.sources import jsonl


def pass_through(ads: DataFrame) -> DataFrame:
    return changes.as_inserts(ads.select("ad_id", "city"))


def filter_null_cities(ads: DataFrame) -> DataFrame:
    return changes.as_inserts(rows.known_cities(ads).select("ad_id", "city"))


def dedup(ads: DataFrame) -> DataFrame:
    return changes.as_inserts(jobs.distinct_ads(ads))


def count_by_city(ads: DataFrame) -> DataFrame:
    """Every change of the running counts, city by city in the order the ads were scraped.

    Files in name order and lines in file order are the order of the changes.
    """
    changed = changes.count_changes(rows.with_event_time(rows.known_cities(ads)))
    return changes.as_change_lines(changed.orderBy("city", "seq"), ["city", "num_ads"])


def count_by_city_sliding(ads: DataFrame) -> DataFrame:
    """Fails on an ad without a readable time, which would be in no window."""
    return changes.as_inserts(jobs.windowed_text(jobs.ads_by_city_uneven(ads, strict=True)))


FILE_JOBS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "pass-through": pass_through,
    "filter-null-cities": filter_null_cities,
    "dedup": dedup,
    "count-by-city": count_by_city,
    "count-by-city-sliding": count_by_city_sliding,
}


# Jobs that need the time of every ad.
TIMED = ("count-by-city-sliding",)


def run(spark: SparkSession, name: str, source: str, target: str, quarantine: str | None = None) -> None:
    """Runs one of the jobs; a line that is no JSON fails it.

    So does an ad that the job cannot use, unless there is a ``quarantine`` folder: such ads then go there.
    """
    ads = jsonl.read_ads(spark, source, mode="FAILFAST")
    if quarantine:
        usable = times.event_time(F.col("scraped_time")).isNotNull() if name in TIMED else F.lit(True)
        jsonl.write_ads(ads.filter(~usable), quarantine)
        ads = ads.filter(usable)
    FILE_JOBS[name](ads).write.mode("overwrite").text(target)
