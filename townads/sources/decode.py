"""JSON messages to ad columns, with bad messages set apart rather than lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townads.functions import times
from townads.schema import AD_MESSAGE, AD_RECORD

BAD_JSON = "bad json"
UNKNOWN_FIELD = "unknown field"
NESTED = "nested value"
BAD_TIME = "bad scraped_time"
BAD_DATE = "bad posted_date"

_CORRUPT = "_corrupt"
_MAP = "map<string,string>"


def decode_typed(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages as typed ads plus ``reason``, which is NULL for a good message.

    A missing field becomes the empty string, an explicit null stays NULL. Text that is no JSON
    object, messages with a field the record does not have and fields that hold an object or a list
    get a reason.
    """
    names = AD_RECORD.fieldNames()
    parsed = messages.select(value, _once(F.from_json(F.col(value), _MAP), "_m"))
    members = F.col("_m")
    extra = F.array_except(F.map_keys(members), F.array(*(F.lit(n) for n in names)))
    reason = F.when(members.isNull(), F.lit(BAD_JSON)).when(F.size(extra) > 0, F.lit(UNKNOWN_FIELD))
    reason = reason.when(_nested(F.col(value), members), F.lit(NESTED))
    fields = [_present(members, n).alias(n) for n in AD_MESSAGE.fieldNames()]
    return parsed.select(value, *fields, reason.alias("reason"))


def _nested(text: Column, members: Column) -> Column:
    """Whether a member is an object or a list. The map reader hands these over as their text, as it does
    a string that looks like one; only then the message's own types are looked at."""
    looks = F.exists(F.map_values(members), lambda v: v.startswith("{") | v.startswith("["))
    kinds = F.schema_of_variant(F.try_parse_json(text))
    return looks & F.coalesce(kinds.rlike(r"^OBJECT<.*: (?:OBJECT|ARRAY)<"), F.lit(False))


def _once(parsed: Column, name: str) -> Column:
    """``parsed`` as a generated column.

    Filters on a generated column stay above the generator, whereas filters on a computed one are
    pushed down with a copy of the computation, here the parsing.
    """
    return F.inline(F.array(F.struct(parsed.alias(name))))


def _present(members: Column, name: str) -> Column:
    # Of a name that occurs twice the last value counts, as in the declared reader.
    named = F.filter(F.map_entries(members), lambda e: e.key == name)
    return F.when(F.size(named) > 0, F.try_element_at(named, F.lit(-1))["value"]).when(
        members.isNotNull(), F.lit("")
    )


def decode_rows(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages read by a declared table: unknown fields ignored, missing ones NULL, plus ``reason``."""
    schema = T.StructType(AD_MESSAGE.fields + [T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value), schema, {"columnNameOfCorruptRecord": _CORRUPT})
    rows = messages.select(value, _once(parsed, "_s"))
    bad = F.col("_s").isNull() | F.col(f"_s.{_CORRUPT}").isNotNull()
    return rows.select(
        value,
        *(F.col(f"_s.{n}").alias(n) for n in AD_MESSAGE.fieldNames()),
        F.when(bad, F.lit(BAD_JSON)).alias("reason"),
    )


def decode_coerced(messages: DataFrame, value: str = "value") -> DataFrame:
    """As ``decode_rows``, but a null or missing field becomes the empty string."""
    rows = decode_rows(messages, value)
    return rows.select(
        value,
        *(
            F.when(F.col("reason").isNull(), F.coalesce(F.col(n), F.lit(""))).alias(n)
            for n in AD_MESSAGE.fieldNames()
        ),
        "reason",
    )


def check_times(decoded: DataFrame, posting_date: bool = True, posting_day: bool = False) -> DataFrame:
    """Adds a reason for a scrape time that is no time and a posting date without a year, or, for jobs by
    ``posting_day``, one that is no date."""
    reason = F.when(F.col("reason").isNotNull(), F.col("reason")).when(
        times.event_time(F.col("scraped_time")).isNull(), F.lit(BAD_TIME)
    )
    if posting_date:
        reason = reason.when(~times.has_year(times.posted_year(F.col("posted_date"))), F.lit(BAD_DATE))
    if posting_day:
        reason = reason.when(times.posting_day(F.col("posted_date")).isNull(), F.lit(BAD_DATE))
    return decoded.withColumn("reason", reason)


def good(decoded: DataFrame, value: str = "value") -> DataFrame:
    return decoded.filter("reason IS NULL").drop(value, "reason")


def quarantined(decoded: DataFrame, value: str = "value") -> DataFrame:
    return decoded.filter("reason IS NOT NULL").select(value, "reason")


def strict(decoded: DataFrame, value: str = "value") -> DataFrame:
    """Fails the job on the first message that has a reason."""
    message = F.concat(F.lit("rejected message: "), F.col("reason"), F.lit(": "), F.col(value))
    checked = F.when(F.col("reason").isNull(), F.lit(True)).otherwise(
        F.raise_error(message).cast("boolean")
    )
    return decoded.filter(checked).drop(value, "reason")
