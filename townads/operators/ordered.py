"""Numbering rows in order across tasks when one key may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from townads.session import scratch_folder


def sliced(rows: DataFrame, keys: list[str], order: list[str], slices: int | None = None) -> DataFrame:
    """Rows range-partitioned by keys and order, with the number of their ``slice``.

    Slices are about equal in size whatever the distribution of keys: a hot key, or a group of
    equal rows, is spread over several. The result is a table in the shared folder, so that the
    slice of a row stays the same however often a task is run again.
    """
    spark = rows.sparkSession
    path = scratch_folder(spark, "slices")
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    by = [*keys, *order, "_tie"]
    ranged = tied.repartitionByRange(slices, *by) if slices else tied.repartitionByRange(*by)
    ranged.withColumn("slice", F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def numbered(
    rows: DataFrame, keys: list[str], order: list[str], value: str, slices: int | None = None
) -> DataFrame:
    """Adds ``row_no`` and ``value_no``: rows and non-null values of the key up to and with this row."""
    counted = rows.withColumn("_one", F.col(value).isNotNull().cast("long"))
    return running(counted, keys, order, "_one", slices).withColumnRenamed("total", "value_no").drop("_one")


def running(
    rows: DataFrame, keys: list[str], order: list[str], amount: str, slices: int | None = None
) -> DataFrame:
    """Adds ``row_no`` and ``total``: rows and sum of ``amount`` of the key up to and with this row.

    Each slice counts on its own and starts from the totals of the earlier slices of its key.
    Totals are one row per key and slice.
    """
    # A struct of the keys equals another one also where both hold NULL, and the count and the
    # join below can then share one shuffle.
    table = sliced(rows, keys, order, slices).withColumn("_key", F.struct(*keys))
    run = ["slice", "_key"]
    here = W.partitionBy(*run).orderBy(*order, "_tie").rowsBetween(W.unboundedPreceding, 0)
    earlier = W.partitionBy("_key").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    counted = table.select(
        *run, *rows.columns, F.count("*").over(here).alias("_r"), F.sum(amount).over(here).alias("_v")
    )
    totals = table.groupBy(*run).agg(F.count("*").alias("_rows"), F.sum(amount).alias("_values"))
    offsets = totals.select(
        *run,
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_values").over(earlier), F.lit(0)).alias("_values_before"),
    )
    return counted.join(offsets, run).select(
        *rows.columns,
        (F.col("_rows_before") + F.col("_r")).alias("row_no"),
        (F.col("_values_before") + F.col("_v")).alias("total"),
    )
