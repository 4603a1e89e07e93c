"""From raw documents to token ids, in stages that are each written as a table before the next begins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from townads.llm import bpe, decontamination, language, similar, substrings
from townads.llm.frames import stored, table

#: Documents whose language is less certain are rejected, as are those without any letter. With two languages a family
#: the winner's certainty is never below one half, so there only texts without letters go.
LEAST_CERTAINTY = 0.5


def _identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a learnt language; fills in a missing ``lang``. Null texts and those without a letter go;
    repeated rows and rows without an id are judged one by one; an empty table gives no rows."""
    found = language.identify(docs, language.learnt(docs), keep_text=True)
    sure = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_CERTAINTY)
    return found.where(sure).withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def _drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near copies the document with the least id, once."""
    first = similar.near_copies(docs).where("first").select(F.col("key").alias("row_key")).distinct()
    keyed = docs.withColumn("row_key", similar.row_key("doc_id", "text"))
    return keyed.join(first, "row_key", "left_semi").dropDuplicates(["row_key"]).select(*docs.columns)


def _cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that an earlier document holds out of the texts; every document stays."""
    others = tuple(name for name in docs.columns if name not in ("doc_id", "text"))
    cut = substrings.remove_repeats(docs, outputs=("left",), carried=others).withColumnRenamed("left", "text")
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which at least a twentieth lies in benchmark passages."""
    # Rows are told apart by id and text, as ids may repeat.
    keyed = docs.withColumn("row_key", F.xxhash64("doc_id", "text"))
    judged = decontamination.verdicts(keyed, table(spark, sf_dir, "benchmark"), id="row_key")
    gone = judged.where("contaminated").select("row_key").distinct()
    return keyed.join(gone, "row_key", "left_anti").select(*docs.columns)


def _encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with the digests of the ids and of the text that they decode to."""
    return bpe.encode(
        docs,
        public_tokenizers.path("word_bpe_49k.json"),
        outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"),
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", _identify_language),
    ("near copies", _drop_near_copies),
    ("repeated passages", _cut_repeats),
    ("decontamination", _decontaminate),
    ("encoding", _encode),
]

#: Trained models and iterations have no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
