"""Event time, posting date and duration handling."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_SQL_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,9})?$"
_DAY_MONTH_YEAR = r"^(0[1-9]|[12][0-9]|3[01]| ?[1-9])-(0?[1-9]|1[0-2])-([0-9]{4})$"

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def seconds(duration: str) -> int:
    """Length of a literal such as ``'300 seconds'``; anything but one whole number and unit fails."""
    match = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", duration) if isinstance(duration, str) else None
    if not match or match.group(2) not in _UNIT_SECONDS or int(match.group(1)) == 0:
        raise ValueError(f"not a positive time literal: {duration!r}")
    return int(match.group(1)) * _UNIT_SECONDS[match.group(2)]


def _if_matches(col: Column, pattern: str) -> Column:
    return F.when(col.rlike(pattern), col)


def event_time(col: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text, also with a ``T`` or a fraction of a second, as a zone-less timestamp;
    other text gives NULL."""
    return _if_matches(col, _SQL_TIME).try_cast("timestamp_ntz")


def iso_time(col: Column) -> Column:
    """ISO date or date-time text as a zone-less timestamp; other text gives NULL."""
    return col.try_cast("timestamp_ntz")


def epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def to_epoch_millis(ts: Column) -> Column:
    """Milliseconds since the epoch of a zone-less timestamp, read as UTC."""
    micros = F.timestamp_diff("MICROSECOND", epoch(), ts)
    return ((micros - F.pmod(micros, F.lit(1000))) / 1000).cast("long")


def from_epoch_millis(millis: Column) -> Column:
    """Zone-less UTC timestamp of an epoch value, truncated to whole seconds."""
    return F.timestamp_add("SECOND", ((millis - millis % 1000) / 1000).cast("long"), epoch())


def posted_year(posted_date: Column) -> Column:
    """First four characters of the posting date; not validated."""
    return F.substring(posted_date, 1, 4)


def posting_day(posted_date: Column) -> Column:
    """Start of the posting date's day as a zone-less timestamp; NULL for text that is no date."""
    return posted_date.try_cast("date").cast("timestamp_ntz")


def has_year(year: Column) -> Column:
    """TRUE for four characters, digits or not; FALSE for fewer and for NULL."""
    return F.coalesce(F.length(year) == 4, F.lit(False))


def posted_date(text: Column) -> Column:
    """ISO date from text ending in ``dd/MM/yyyy``; NULL when the ending is no such date."""
    tail = _if_matches(F.translate(F.right(text, F.lit(10)), "/", "-"), _DAY_MONTH_YEAR)
    day, month, year = (F.regexp_extract(tail, _DAY_MONTH_YEAR, i) for i in (1, 2, 3))
    iso = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(F.ltrim(day), 2, "0"))
    return F.when(tail.isNotNull(), iso).try_cast("date").cast("string")


def stamp(moment: Column) -> Column:
    """A timestamp in the text form of ``scraped_time``."""
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")
