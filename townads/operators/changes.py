"""Change records of a running count: each new count first withdraws the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townads.functions import wire
from townads.operators.ordered import running

INSERT, DELETE = "INSERT", "DELETE"
# Changes of one moment are written out in blocks of so many, so that no array holds a hot moment.
BLOCK = 4096


def count_changes(rows: DataFrame, key: str = "city", value: str = "ad_id", slices: int | None = None) -> DataFrame:
    """Per-row changes of ``count(value)`` by key, in the order of ``ts`` then ``value``. Batch only.

    Columns: key, ts, seq, op, num_ads. ``seq`` orders the changes of one key. A row without a
    value changes nothing, except that the first row of a key always makes the key appear.
    """
    # Only the counts of a moment matter, not the single rows, so these are counted before the shuffle.
    moments = rows.groupBy(key, "ts").agg(F.count("*").alias("_rows"), F.count(value).alias("_values"))
    counted = running(moments, [key], ["ts"], "_values", slices)
    # Rows without a value come first within a moment; as the first of all they show the key with 0.
    first, blank = F.col("row_no") == 1, F.col("_rows") > F.col("_values")
    low = F.when(first & blank, 0).otherwise(F.col("total") - F.col("_values") + 1)
    blocks = F.when(F.col("low") <= F.col("total"), F.sequence("low", "total", F.lit(BLOCK).cast("long")))
    numbers = F.sequence("_block", F.least(F.col("_block") + (BLOCK - 1), F.col("total")))
    new = F.col("_new")
    changes = F.array(
        F.struct(F.when(~F.col("first") | (new > F.col("low")), new - 1).alias("num_ads"), F.lit(DELETE).alias("op")),
        F.struct(new.alias("num_ads"), F.lit(INSERT).alias("op")),
    )
    return (
        counted.select(key, "ts", "total", first.alias("first"), low.cast("long").alias("low"))
        .select("*", F.explode(blocks).alias("_block"))
        .select(key, "ts", "first", "low", F.explode(numbers).alias("_new"))
        .select(key, "ts", F.inline(F.filter(changes, lambda c: c.num_ads.isNotNull())))
        .withColumn("seq", F.col("num_ads") * 2 + F.when(F.col("op") == DELETE, 1).otherwise(0))
        .select(key, "ts", "seq", "op", "num_ads")
    )


def as_inserts(rows: DataFrame) -> DataFrame:
    """Rows of an append-only result as change lines."""
    return rows.select(wire.change_line(F.lit(INSERT), *(F.col(c) for c in rows.columns)).alias("value"))


def as_change_lines(changes: DataFrame, fields: list[str]) -> DataFrame:
    """Change records as lines of one JSON object each."""
    return changes.select(wire.change_line(F.col("op"), *(F.col(c) for c in fields)).alias("value"))


def folded(changes: DataFrame, key: str = "city") -> DataFrame:
    """The counts that remain after all changes."""
    kept = F.when(F.col("op") == INSERT, F.col("num_ads")).otherwise(-F.col("num_ads"))
    return changes.groupBy(key).agg(F.sum(kept).alias("num_ads"))
