"""Message topics. The broker connector is a separate package named at submit time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townads.functions import wire
from townads.schema import METRIC_LABELS


def read_options(servers: str, topics: list[str], group: str | None = None, **extra: str) -> dict:
    """Options of a topic reader that starts at the earliest record."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    if group:
        options["kafka.group.id"] = group
    return options | extra


def write_options(servers: str, topic: str, **extra: str) -> dict:
    return {"kafka.bootstrap.servers": servers, "topic": topic} | extra


def read_topics(spark: SparkSession, options: dict, streaming: bool = True) -> DataFrame:
    """Records with ``value`` and ``message_key`` as text next to topic and partition."""
    reader = spark.readStream if streaming else spark.read
    rows = reader.format("kafka").options(**options).load()
    return rows.select(
        "topic",
        "partition",
        F.col("key").cast("string").alias("message_key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("ts"),
    )


def first_of_each(records: DataFrame, within: str | None = None, time_col: str = "ts") -> DataFrame:
    """Records without those that were sent again: one of each ``message_key``; records without a key stay.

    On a stream, keys are remembered for ``within``, the time after which no batch is sent again.
    """
    if not records.isStreaming:
        unnamed = F.when(F.col("message_key").isNull(), F.monotonically_increasing_id())
        return records.withColumn("_own", unnamed).dropDuplicates(["message_key", "_own"]).drop("_own")
    if within is None:
        raise ValueError("say how long keys are remembered")
    named = F.coalesce("message_key", F.expr("uuid()"))
    marked = records.withColumn("_own", named).withWatermark(time_col, within)
    return marked.dropDuplicatesWithinWatermark(["_own"]).drop("_own")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Records of the file twin that keeps all that is sent."""
    return spark.read.schema("key string, value string").parquet(path).withColumnRenamed("key", "message_key")


def read_lines(spark: SparkSession, path: str, streaming: bool = True, **options: str) -> DataFrame:
    """The file twin of a topic: one message per line of the files under ``path``."""
    reader = (spark.readStream if streaming else spark.read).options(**options)
    return reader.schema(T.StructType([T.StructField("value", T.StringType())])).text(path)


def write_topic(rows: DataFrame, options: dict, checkpoint: str, mode: str = "append", every: str | None = None):
    """Starts a stream that sends the ``value`` column of ``rows`` to a topic, each time ``every`` has
    passed, or as soon as it can."""
    writer = rows.select("value").writeStream.format("kafka").options(**options)
    if every:
        writer = writer.trigger(processingTime=every)
    return writer.option("checkpointLocation", checkpoint).outputMode(mode).start()


def as_topic(rows: DataFrame, topic: str, fields: list[Column], ts: Column) -> DataFrame:
    """Result rows in the shape in which ``read_topics`` would deliver them."""
    return rows.select(
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(None).cast("string").alias("message_key"),
        wire.to_line(*fields).alias("value"),
        ts.alias("ts"),
    )


def labels(lines: DataFrame) -> DataFrame:
    """Only the labels of JSON lines, as text; NULL when absent."""
    names = METRIC_LABELS.fieldNames()
    return lines.select(F.json_tuple("value", *names).alias(*names))


def with_labels(records: DataFrame, group: str | None = None) -> DataFrame:
    """Topic records as labelled metric lines; every label is text."""
    parsed = records.withColumn("_l", F.from_json("value", METRIC_LABELS))
    kept = ["topic", "partition", "message_key"]
    labels = [F.col(f"_l.{n}").alias(n) for n in METRIC_LABELS.fieldNames()]
    extra = [F.lit(group).alias("group")] if group else []
    return parsed.select(*kept, *extra, *labels, "ts")


def samples(records: DataFrame, topic: str) -> DataFrame:
    """Lines of one topic with ``num_ads`` as a number; lines where it is none are dropped.

    The same as selecting and unwrapping ``with_labels``, but a generator parses each line once
    where a filter on a parsed label would be pushed down and parse it again.
    """
    parsed = F.array(F.from_json("value", METRIC_LABELS))
    usable = F.filter(parsed, lambda l: l.num_ads.try_cast("double").isNotNull())
    lines = records.filter(F.col("topic") == topic).select("topic", "ts", F.inline(usable))
    return lines.withColumn("num_ads", F.col("num_ads").try_cast("double"))
