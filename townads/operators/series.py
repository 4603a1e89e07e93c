"""Roll-ups of result rows over time, as the dashboard panels ask for them.

A range function evaluated at step ``t`` looks at the samples in ``(t - span, t]``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from townads.functions import times
from townads.functions.times import seconds
from townads.operators.windows import MOST_COPIES, running_total

# Steps of one label that are put in order together.
SEGMENT = 4096


def _steps(span: str, step: str, time_col: str) -> Column:
    # window() includes its start and excludes its end; a microsecond's shift swaps the two.
    shifted = F.col(time_col) - F.expr("interval 1 microsecond")
    return F.window(shifted, f"{seconds(span)} seconds", f"{seconds(step)} seconds").alias("w")


def sum_over_time(
    samples: DataFrame, by: list[str], span: str, step: str | None = None, time_col: str = "ts"
) -> DataFrame:
    """Sum of ``num_ads`` by label at each step. Sums of sums are one sum, so one aggregation does.

    A span of more than ``MOST_COPIES`` steps is summed by differences instead of copying each sample to
    every step that sees it; that needs zone-less times, and is exact for numbers whose sums are.
    """
    if seconds(span) > MOST_COPIES * seconds(step or span):
        return _sums_of_differences(samples, by, seconds(span), seconds(step), time_col)
    steps = _steps(span, step or span, time_col)
    sums = samples.groupBy(*by, steps).agg(F.sum("num_ads").alias("num_ads"))
    return sums.select(*by, F.col("w.end").alias("step"), "num_ads")


def _micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", times.epoch(), ts)


def _first_step(micros: Column, span: int, step: int) -> Column:
    """The first step at or after a time; steps lie ``span`` after multiples of ``step``."""
    shift = (span % step) * 1_000_000
    return micros + F.pmod(F.lit(shift) - micros, F.lit(step * 1_000_000))


def _moment(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, times.epoch())


def _between(first: Column, end: Column, step: int) -> Column:
    """The steps from ``first`` up to but not including ``end``."""
    every = F.lit(step * 1_000_000).cast("long")
    return F.explode(F.when(first < end, F.sequence(first, end - every, every)))


def _sums_of_differences(samples: DataFrame, by: list[str], span: int, step: int, time_col: str) -> DataFrame:
    """A sample is added at the first step that sees it and taken away at the first that no longer does.

    Differences are summed by label and step before they are put in order, so a label has at most two rows
    a step however many samples it has. The running sum goes segment by segment of the time line, each
    starting from the sum of the segments before it, so a label's steps are not one task's work.
    """
    ts = _micros(F.col(time_col))
    value, known = F.coalesce("num_ads", F.lit(0)), F.col("num_ads").isNotNull().cast("long")
    one = F.lit(1).cast("long")
    enters = F.struct(_first_step(ts, span, step).alias("at"), value.alias("v"), known.alias("k"), one.alias("n"))
    leaves = F.struct(
        _first_step(ts + span * 1_000_000, span, step).alias("at"), (-value).alias("v"), (-known).alias("k"), (-one).alias("n")
    )
    moved = samples.where(F.col(time_col).isNotNull()).select(*by, F.inline(F.array(enters, leaves)))
    amounts = ("v", "k", "n")
    changes = (
        moved.groupBy(*by, "at")
        .agg(*(F.sum(c).alias(c) for c in amounts))
        # A struct of the labels equals another one also where both hold NULL.
        .select("*", F.struct(*by).alias("_by"), F.floor(F.col("at") / (SEGMENT * step * 1_000_000)).alias("_segment"))
    )
    here = W.partitionBy("_by", "_segment").orderBy("at")
    inside = changes.select(
        *by, "_by", "_segment", "at",
        *(F.sum(c).over(here.rowsBetween(W.unboundedPreceding, 0)).alias(c) for c in amounts),
        F.lead("at").over(here).alias("until"),
    )
    order = W.partitionBy("_by").orderBy("_segment")
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    totals = changes.groupBy("_by", "_segment").agg(F.min("at").alias("first"), *(F.sum(c).alias(c) for c in amounts))
    offsets = totals.select(
        "_by", "_segment", F.lead("first").over(order).alias("_next"),
        *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in amounts),
    )
    running = inside.join(offsets, ["_by", "_segment"]).select(
        *by, "at", F.coalesce("until", "_next").alias("until"), *((F.col(c) + F.col(f"_{c}")).alias(c) for c in amounts)
    )
    seen = running.where("n > 0").select(*by, F.when(F.col("k") > 0, F.col("v")).alias("num_ads"), _between(F.col("at"), F.col("until"), step).alias("_at"))
    return seen.select(*by, _moment(F.col("_at")).alias("step"), "num_ads")


def last_over_time(
    samples: DataFrame, by: list[str], span: str, step: str | None = None, time_col: str = "ts"
) -> DataFrame:
    """Latest ``num_ads`` by label at each step; the larger of two at the same time.

    A sample holds from its time up to the next sample of its label, or the end of its span if that is
    earlier, so each step of a label is written once whatever the span. Samples are put in order segment by
    segment of the time line; a segment's last sample ends at the first of the next segment. Times are zone-less.
    """
    reach, every = seconds(span), seconds(step or span)
    length = max(reach, SEGMENT * every) * 1_000_000
    timed = samples.where(F.col(time_col).isNotNull()).select(
        *by, "num_ads", F.struct(*by).alias("_by"), _micros(F.col(time_col)).alias("_ts")
    )
    cut = timed.withColumn("_segment", F.floor(F.col("_ts") / length))
    order = W.partitionBy("_by", "_segment").orderBy("_ts", "num_ads")
    held = cut.withColumn("_until", F.lead("_ts").over(order))
    # A span ends within the next segment at the latest, so no later one matters.
    following = cut.groupBy("_by", (F.col("_segment") - 1).alias("_segment")).agg(F.min("_ts").alias("_next"))
    ends = F.least(F.coalesce("_until", "_next"), F.col("_ts") + reach * 1_000_000)
    steps = _between(_first_step(F.col("_ts"), reach, every), _first_step(ends, reach, every), every)
    expanded = held.join(following, ["_by", "_segment"], "left").select(*by, "num_ads", steps.alias("_at"))
    return expanded.select(*by, _moment(F.col("_at")).alias("step"), "num_ads")


def last_not_null(samples: DataFrame, by: list[str], time_col: str = "step") -> DataFrame:
    """One value per series: its latest that is not NULL, the larger of two at the same time. Each task keeps
    one row of a series before the shuffle."""
    order = W.partitionBy(*by).orderBy(F.desc(time_col), F.desc("num_ads"))
    ranked = samples.filter(F.col("num_ads").isNotNull()).withColumn("_r", F.row_number().over(order))
    return ranked.filter(F.col("_r") == 1).select(*by, "num_ads")


def totals(samples: DataFrame, by: list[str]) -> DataFrame:
    return samples.groupBy(*by).agg(F.sum("num_ads").alias("num_ads"))


def cumulative(samples: DataFrame, by: list[str], time_col: str = "w_start") -> DataFrame:
    """Sum so far by label at each time. Batch only.

    The samples are first summed to one row per label and time, which bounds what is ordered per
    label by the number of windows.
    """
    sums = samples.groupBy(*by, time_col).agg(F.sum("num_ads").alias("num_ads"))
    return running_total(sums, by, time_col)
