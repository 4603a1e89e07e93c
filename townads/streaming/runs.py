"""Streams from JSON messages to tables and topics.

Every sink here can be run again: the file sink keeps its own log, and whatever is written batch
by batch goes to a folder named after the batch, which a repeated batch overwrites.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from townads.functions import wire
from townads.operators import windows
from townads.operators.changes import DELETE, INSERT
from townads.schema import AD_ITEM
from townads.sources import decode

BatchWriter = Callable[[DataFrame, int], None]


def decoded(lines: DataFrame, typed: bool = False) -> DataFrame:
    """Messages with their ad columns and the reason why they cannot be used, if any.

    ``typed`` reads them the way the tumbling job does, which also needs a posting year.
    """
    read = decode.decode_typed if typed else decode.decode_rows
    return decode.check_times(read(lines), posting_date=typed)


def ads_from_lines(lines: DataFrame, typed: bool = False, strict: bool = False) -> DataFrame:
    """Good ads of a stream of messages; ``strict`` fails on the first other message."""
    rows = decoded(lines, typed)
    return decode.strict(rows) if strict else decode.good(rows)


def _writer(result: DataFrame, checkpoint: str, mode: str, every: str | None):
    writer = result.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def to_table(result: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Appends closed windows, or other rows that never change, to a parquet table.

    Without ``every`` the query handles what is there and ends.
    """
    return _writer(result, checkpoint, "append", every).format("parquet").start(path)


def to_batches(
    result: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "append", every: str | None = None
) -> StreamingQuery:
    return _writer(result, checkpoint, mode, every).foreachBatch(write).start()


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def write_parquet(path: str) -> BatchWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    return write


def fan_out(items: str, send: BatchWriter, spider: str) -> BatchWriter:
    """Each ad goes to a JSONL folder first and then, with the spider's name, to a topic."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            lines = batch.select(*AD_ITEM.fieldNames())
            lines.write.mode("overwrite").option("ignoreNullFields", "false").json(
                batch_folder(items, batch_id)
            )
            named = batch.withColumn("spider", F.lit(spider))
            send(named.select(wire.to_line(*AD_ITEM.fieldNames(), "spider").alias("value")), batch_id)
        finally:
            batch.unpersist()

    return write


def send_to_files(path: str) -> BatchWriter:
    """The file twin of a topic."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").text(batch_folder(path, batch_id))

    return write


def keyed(lines: DataFrame, batch_id: int) -> DataFrame:
    """Messages (``value``) with a ``key`` that each has again when its batch is sent again."""
    return lines.select(wire.message_key(F.col("value"), batch_id).alias("key"), "value")


def send_to_log(path: str) -> BatchWriter:
    """The file twin of a topic that keeps all that is sent, also what is sent again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        keyed(batch, batch_id).write.mode("append").parquet(path)

    return write


def send_to_topic(options: dict) -> BatchWriter:
    """At least once, as a repeated batch sends its messages again; ``topics.first_of_each`` tells them by their
    keys."""

    def write(batch: DataFrame, batch_id: int) -> None:
        keyed(batch, batch_id).write.format("kafka").options(**options).save()

    return write


def set_apart(good: BatchWriter, bad_path: str, typed: bool = True) -> BatchWriter:
    """Good ads go on to ``good``, bad messages with their reason to a side table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = decoded(batch, typed).persist()
        try:
            good(decode.good(rows), batch_id)
            decode.quarantined(rows).write.mode("overwrite").parquet(batch_folder(bad_path, batch_id))
        finally:
            rows.unpersist()

    return write


def top_k(path: str, k: int) -> BatchWriter:
    """The largest counts of each closed window.

    Fed by windowed counts in append mode: all rows of a window arrive in the batch that closes it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        windows.top_k(batch, k).write.mode("overwrite").parquet(batch_folder(path, batch_id))

    return write


def count_changes(path: str, state: str, key: str = "city", value: str = "ad_id", merge_every: int = 32) -> BatchWriter:
    """Change records of a running count, one pair per key and batch.

    A batch writes the new counts of the keys it touches, in a folder named after the batch. Every
    ``merge_every`` batches the counts of all keys are written together, in a folder named after the batch that
    does it, and later batches read that one and what came since. Whatever a batch writes it works out from earlier
    batches only, so a repeated batch finds its input unchanged and writes the same. Old folders can go once the
    batch after the next merge is done.
    """

    def counts_before(spark, batch_id: int) -> DataFrame:
        """The counts of all keys before a batch, from the last merge and the batches since."""
        merged = (batch_id - 1) // merge_every * merge_every if batch_id else 0
        since = [f"{state}/touched/{n}" for n in range(merged, batch_id)]
        folders = since if not merged else [f"{state}/all/{merged}", *since]
        known = spark.read.schema(f"{key} string, num_ads long").parquet(*folders)
        # Counts never fall, so the newest of a key is the largest.
        return known.groupBy(F.col(key).alias("_key")).agg(F.max("num_ads").alias("old"))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        news = batch.groupBy(key).agg(F.count(value).alias("new"))
        if batch_id and batch_id % merge_every == 0:
            everything = counts_before(spark, batch_id).select(F.col("_key").alias(key), F.col("old").alias("num_ads"))
            everything.write.mode("overwrite").parquet(f"{state}/all/{batch_id}")
        if batch_id == 0:
            both = news.withColumn("old", F.lit(None).cast("long"))
        else:
            both = news.join(counts_before(spark, batch_id), F.col("_key").eqNullSafe(F.col(key)), "left")
        touched = both.select(key, "old", (F.coalesce("old", F.lit(0)) + F.col("new")).alias("num_ads"))
        target = f"{state}/touched/{batch_id}"
        touched.write.mode("overwrite").parquet(target)
        pair = F.array(
            F.struct(F.col("old").alias("n"), F.lit(DELETE).alias("op")),
            F.struct(F.col("num_ads").alias("n"), F.lit(INSERT).alias("op")),
        )
        # A key whose ads have no id appears with 0 and then does not change.
        changed = F.col("old").isNull() | (F.col("num_ads") > F.col("old"))
        changes = (
            spark.read.schema(f"{key} string, old long, num_ads long")
            .parquet(target)
            .filter(changed)
            .select(key, F.inline(F.filter(pair, lambda c: c.n.isNotNull())))
            .select(key, "op", F.col("n").alias("num_ads"))
        )
        changes.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    return write


def _spans(batches: int, merge_every: int) -> list[tuple[int, int]]:
    """The folders (level, number) that together hold the batches before ``batches``: number ``i`` of a level
    holds the batches from ``i * merge_every**level`` up to the next number's, larger ones come first."""
    found, start, level = [], 0, 0
    while merge_every ** (level + 1) <= batches:
        level += 1
    for level in range(level, -1, -1):
        size = merge_every**level
        while start + size <= batches:
            found.append((level, start // size))
            start += size
    return found


def first_seen(path: str, state: str, names: list[str], buckets: int = 256, merge_every: int = 32) -> BatchWriter:
    """Rows whose values in ``names`` no earlier batch had, each once; NULL is a value.

    What was seen is a table, not state of the stream: its rows are dealt by hash into ``buckets``, a batch
    joins its rows with those of the buckets it meets, and writes the new ones in a folder named after the
    batch. ``merge_every`` folders of one level are written together as one of the next, so a batch reads few
    folders and a row is written again a logarithm of times. Whatever a batch writes it works out from earlier
    batches only, so a repeated batch writes the same. Folders that are merged can go once the batch that merged them is
    done. ``buckets`` must stay the same for a table.
    """

    def folder(level: int, number: int) -> str:
        return f"{state}/_level={level}/_number={number}"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(*names)
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

        def read(*folders: tuple[int, int]) -> DataFrame:
            table = spark.read.schema(f"{fields}, _level int, _number int, _bucket int").option("basePath", state)
            return table.parquet(*(folder(*x) for x in folders)).select(*names, "_bucket")

        def keep(kept: DataFrame, level: int, number: int) -> None:
            dealt = kept.repartition("_bucket")
            dealt.write.mode("overwrite").partitionBy("_bucket").parquet(folder(level, number))

        level = 1
        while batch_id and batch_id % merge_every**level == 0:
            number = batch_id // merge_every**level - 1
            below = range(number * merge_every, (number + 1) * merge_every)
            keep(read(*((level - 1, n) for n in below)), level, number)
            level += 1
        met = rows.distinct().withColumn("_bucket", F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int")).persist()
        try:
            new = met
            if batch_id:
                # At most ``buckets`` numbers; the scan leaves the other buckets' folders alone.
                among = [r[0] for r in met.select("_bucket").distinct().collect()]
                known = read(*_spans(batch_id, merge_every)).where(F.col("_bucket").isin(among))
                known = known.toDF(*(f"_seen_{i}" for i in range(len(names))), "_seen_bucket")
                equal = F.col("_bucket") == F.col("_seen_bucket")
                for i, name in enumerate(names):
                    equal = equal & F.col(name).eqNullSafe(F.col(f"_seen_{i}"))
                new = met.join(known, equal, "left_anti")
            keep(new, 0, batch_id)
        finally:
            met.unpersist()
        read((0, batch_id)).drop("_bucket").write.mode("overwrite").parquet(batch_folder(path, batch_id))

    return write
