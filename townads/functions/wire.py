"""JSON text in and out: messages, change records and result rows."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from townads.functions import times


def wire_time(ts: Column, zoned: bool = False) -> Column:
    """Result time as ``yyyy-MM-dd HH:mm:ss`` plus the milliseconds if any; ``Z`` marks UTC.

    With ``zoned`` a zoned time is turned to UTC, whatever the zone of the session, and a zone-less one
    is taken as UTC. Otherwise a zone-less time stays as it is and a zoned one is given in the session's zone.
    """
    plain = ts.cast("timestamp_ntz")
    if zoned:
        utc = F.timestamp_add("MICROSECOND", F.unix_micros(ts.cast("timestamp")), times.epoch())
        plain = F.when(F.typeof(ts) == "timestamp", utc).otherwise(plain)
    # Milliseconds, without zeros at their end. Truncating functions would give the time a zone.
    text = F.regexp_replace(F.regexp_replace(plain.cast("string"), r"([.]\d{3})\d+$", "$1"), r"([.]\d*?)0+$", "$1")
    text = F.regexp_replace(text, r"[.]$", "")
    return F.concat(text, F.lit("Z")) if zoned else text


def to_line(*fields: Column) -> Column:
    """One JSON object with every field present, NULLs included."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def message_key(line: Column, batch_id: int) -> Column:
    """A key that a message has again when its batch is sent again, and no other message has: the batch, a
    digest of the message, and its number among equal ones of the batch."""
    number = F.row_number().over(Window.partitionBy(line).orderBy(F.lit(0)))
    return F.concat_ws("-", F.lit(str(batch_id)), F.sha2(line, 256), number.cast("string"))


def change_line(op: Column, *fields: Column) -> Column:
    """Change record: the row under ``data`` and the kind of change under ``type``."""
    return to_line(F.array(F.struct(*fields)).alias("data"), op.alias("type"))
