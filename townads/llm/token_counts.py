"""Token counts of documents through a table of counts known by content digest."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from townads.llm.frames import stored, table
from townads.llm.vocabulary import Encoder, shipped, splits_at_spaces
from townads.session import scratch_folder

TOKEN_LIMIT = 2048
_CACHE = "tokenizer string, content string, n_tokens long"


def _counter(model: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(model)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            counts = [coder.count(text.as_py()) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64())], names=["content", "n_tokens"]
            )

    return run


def _normalised(text: Column, by_word: bool) -> Column:
    """Texts that must have equal counts become equal: null is empty and, where the tokenizer drops
    white space, runs of it are one space."""
    text = F.coalesce(text, F.lit(""))
    return F.trim(F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " ")) if by_word else text


def count_tokens(
    docs: DataFrame, tokenizer: str, cache: str, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes`` (UTF-8) and ``n_tokens``.

    ``cache`` is a folder of counts, keyed by the digests of normalised content and of the tokenizer
    file; it may be missing. Contents it lacks are encoded once each, whatever the number of their
    copies, and appended to it. A job that died between encoding and appending just encodes again; two
    jobs that append the same counts do no harm.

    Nulls and edges: a null text counts as empty, with 0 bytes and 0 tokens; null or repeated ids are
    rows of their own; other columns are not read.
    """
    spark = docs.sparkSession
    model = shipped(spark, tokenizer)
    is_json, content = model.value
    version = hashlib.sha256(content).hexdigest()
    whole = _normalised(F.col(text), is_json and splits_at_spaces(content))
    rows = docs.select(
        F.col(id).alias("id"),
        F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"),
        whole.alias("text"),
    ).withColumn("content", F.sha2("text", 256))
    spark.createDataFrame([], _CACHE).write.mode("append").parquet(cache)  # so that it can be read
    known = spark.read.schema(_CACHE).parquet(cache).where(F.col("tokenizer") == version)
    (
        rows.select("content", "text")
        .join(known, "content", "left_anti")
        .groupBy("content")
        .agg(F.first("text").alias("text"))
        .mapInArrow(_counter(model), "content string, n_tokens long")
        .select(F.lit(version).alias("tokenizer"), "content", "n_tokens")
        .write.mode("append")
        .parquet(cache)
    )
    counts = (
        spark.read.schema(_CACHE)
        .parquet(cache)
        .where(F.col("tokenizer") == version)
        .groupBy("content")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )
    # A table of its own: a join with an aggregate cannot split the rows of a content with many copies.
    counts = stored(counts, "counts")
    return rows.select("id", "n_bytes", "content").join(counts, "content").select(
        F.col("id").alias(id), "n_bytes", "n_tokens"
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, starting from an empty cache."""
    counted = count_tokens(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        scratch_folder(spark, "token-counts"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


QUERIES = {"op6_token_counts": op6_token_counts}
