"""Removal of word passages that an earlier document holds already.

Every window of ``length`` consecutive words gets a Rabin-Karp value. A map task reduces its batch of
documents to the distinct values, each with the first document that has it, so a passage in a third of
all documents costs one entry per batch. The values are dealt by hash into buckets and packed there;
each bucket finds the first document of every value and answers each batch with the values that its
documents have to remove. The document's words are then hashed again, and all windows with an answered value merge
into maximal intervals.

A value is 64 bits within its bucket, and the bucket comes from a second Rabin-Karp base, so about
``64 + log2(buckets)`` bits tell two windows apart: of n windows, n * 1e-13 are expected to be
mistaken for another at any size, since the buckets grow with the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from townads.llm.frames import table, text_bytes
from townads.llm.words import UNCHANGED, Words, buffers, parts, rolling, thrifty, words_of

WINDOW = 13
BUCKET_BYTES = 8 << 20
BATCH_BYTES = 3 << 20  # texts that a task looks at together; a longer text alone
_SECOND_BASE = 0xA0761D6478BD642F
_LAST = (1 << 63) - 1  # stands for a missing id: such a row comes after all others


def _windows(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Value and first word of every window that lies within one row."""
    values = rolling(words.prints, length)
    whole = np.flatnonzero(words.rows[: len(values)] == words.rows[length - 1 :])
    return values[whole], whole


def _packed(keys: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """Per key the part of each column as bytes."""
    if not len(keys):
        return
    order = np.argsort(keys, kind="stable")
    keys, columns = keys[order], [c[order] for c in columns]
    cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    for low, high in zip(cuts, [*cuts[1:], len(keys)]):
        yield int(keys[low]), *(c[low:high].tobytes() for c in columns)


def _pressed(x: np.ndarray) -> bytes:
    return zstandard.compress(x.tobytes(), 1)


def _first_seen(length: int, buckets: int) -> Callable:
    """Per batch and bucket: the distinct values with the number of their first document, and, as
    answers already known, the values that later documents of the batch repeat."""
    kinds = {"bucket": pa.int64(), "block": pa.string()}
    kinds |= dict.fromkeys(("ids", "values", "docs", "again", "again_docs"), pa.binary())
    schema = pa.schema(list(kinds.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = TaskContext.get().partitionId()
        for n, rows in enumerate(part for batch in batches for part in parts(batch, "text", BATCH_BYTES)):
            rows = rows.sort_by("id")
            ids = rows["id"].to_numpy()
            words = words_of(rows["text"], UNCHANGED)
            values, at = _windows(words, length)
            if not len(values):
                continue
            bucket = (rolling(words.prints, length, _SECOND_BASE)[at] % np.uint64(buckets)).astype(np.int64)
            docs = words.rows[at].astype(np.int32)
            order = np.argsort(values, kind="stable")
            values, bucket, docs = values[order], bucket[order], docs[order]
            fresh = np.ones(len(values), dtype=bool)
            fresh[1:] = (values[1:] != values[:-1]) | (bucket[1:] != bucket[:-1])
            # Equal values of different buckets are told apart by a second sort, which hardly ever happens.
            if ((values[1:] == values[:-1]) & (bucket[1:] != bucket[:-1])).any():
                order = np.lexsort((docs, bucket, values))
                values, bucket, docs = values[order], bucket[order], docs[order]
                fresh[1:] = (values[1:] != values[:-1]) | (bucket[1:] != bucket[:-1])
            leader = np.flatnonzero(fresh)
            first = np.repeat(docs[leader], np.diff(np.append(leader, len(docs))))
            later = ids[docs] > ids[first]
            later[1:] &= fresh[1:] | (docs[1:] != docs[:-1])  # once for each document
            again = {k: x for k, *x in _packed(bucket[later], values[later], docs[later])}
            packed_ids = _pressed(np.diff(ids.astype(np.int64), prepend=0))
            leader = leader[np.argsort(docs[leader], kind="stable")]
            out = [
                (k, f"{own}-{n}", packed_ids, v, _pressed(np.diff(np.frombuffer(d, np.int32), prepend=np.int32(0))), *again.pop(k, (None, None)))
                for k, v, d in _packed(bucket[leader], values[leader], docs[leader])
            ]
            for low in range(0, len(out), 64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out[low : low + 64]), schema)], schema=schema
                )

    return run


def _answered(group: pa.Table) -> pa.Table:
    """The values of a bucket that documents repeat from documents with a smaller id, packed by block."""
    rows = group.select(["block", "ids", "values", "docs", "again", "again_docs"]).to_pylist()
    known = [np.cumsum(np.frombuffer(zstandard.decompress(row["ids"]), np.int64)) for row in rows]
    docs = [np.cumsum(np.frombuffer(zstandard.decompress(row["docs"]), np.int32)) for row in rows]
    values = np.concatenate([np.frombuffer(row["values"], np.uint64) for row in rows])
    ids = np.concatenate([k[d] for k, d in zip(known, docs)])
    order = np.argsort(values, kind="stable")
    sorted_values, sorted_ids = values[order], ids[order]
    leader = np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1]))
    least = np.empty_like(ids)
    least[order] = np.repeat(np.minimum.reduceat(sorted_ids, leader), np.diff(np.append(leader, len(ids))))
    repeated = ids > least
    out, at = [], 0
    for row, k, d in zip(rows, known, docs):
        mine = np.flatnonzero(repeated[at : at + len(d)]) + at
        found, whose = [values[mine]], [ids[mine]]
        at += len(d)
        if row["again"]:
            found.append(np.frombuffer(row["again"], np.uint64))
            whose.append(k[np.frombuffer(row["again_docs"], np.int32)])
        found, whose = np.concatenate(found), np.concatenate(whose)
        if len(found):
            order = np.argsort(whose, kind="stable")
            out.append((row["block"], found[order].tobytes(), _pressed(np.diff(whose[order], prepend=0))))
    names = {"block": pa.string(), "values": pa.binary(), "ids": pa.binary()}
    return pa.table({n: pa.array([x[i] for x in out], t) for i, (n, t) in enumerate(names.items())})


def _by_document(group: pa.Table) -> pa.Table:
    """The answers to a block, one row for each of its documents that has any."""
    rows = group.to_pylist()
    values = np.concatenate([np.frombuffer(row["values"], np.uint64) for row in rows])
    ids = np.concatenate([np.cumsum(np.frombuffer(zstandard.decompress(row["ids"]), np.int64)) for row in rows])
    out = list(_packed(ids, values))
    return pa.table({"id": pa.array([x[0] for x in out], pa.int64()), "values": pa.array([x[1] for x in out], pa.binary())})


def _intervals(hit: np.ndarray, length: int) -> np.ndarray:
    """Maximal [from, to) word intervals that the windows starting at ``hit`` (ascending) cover."""
    if not len(hit):
        return np.zeros((0, 2), dtype=np.int64)
    opens = np.flatnonzero(np.append(True, hit[1:] > hit[:-1] + length))
    closes = np.append(opens[1:], len(hit)) - 1
    return np.stack([hit[opens], hit[closes] + length], axis=1)


def _cut(length: int, names: list[str], schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for batch in batches for part in parts(batch, "text", BATCH_BYTES)):
            texts = batch["text"].combine_chunks()
            words = words_of(texts, UNCHANGED)
            data, offsets = buffers(texts)
            raw = memoryview(data)
            found = batch["values"]
            spans, kept, left, removed = [], [], [], []
            for row in range(len(texts)):
                low, high = int(words.first[row]), int(words.first[row + 1])
                intervals = np.zeros((0, 2), dtype=np.int64)
                if found[row].is_valid:
                    wanted = np.concatenate([np.frombuffer(x, np.uint64) for x in found[row].as_py()])
                    intervals = _intervals(np.flatnonzero(np.isin(rolling(words.prints[low:high], length), wanted)), length)
                stretches, at = [], low
                for a, b in [*(intervals + low).tolist(), (high, high)]:
                    if a > at:
                        stretches.append(bytes(raw[words.starts[at] : words.ends[a - 1]]))
                    at = b
                spans.append(intervals.tolist())
                removed.append(int((intervals[:, 1] - intervals[:, 0]).sum()))
                kept.append(b" ".join(word for stretch in stretches for word in stretch.split()))
                if not texts[row].is_valid:
                    left.append(None)
                else:
                    left.append(b" ".join(stretches) if len(intervals) else bytes(raw[offsets[row] : offsets[row + 1]]))
            made = {
                "n_words": pa.array(np.diff(words.first), pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "removed": pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
                "left": pa.array(left, pa.binary()).cast(pa.string()),
            }
            made["kept_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())
            yield from pa.table([made[n] if n in made else batch[n] for n in names], schema=schema).to_batches()

    return run


def remove_repeats(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    length: int = WINDOW,
    outputs: tuple[str, ...] = ("n_words", "n_removed", "removed", "left"),
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """Each row's id, and the columns ``carried``, with what is left of its text.

    A word (``[^ \\t-\\r]+``) goes if a window of ``length`` words covers it whose word sequence also
    starts in a row with a smaller id. Windows are judged on the input, not on what is left.

    Outputs to choose from: ``n_words``; ``n_removed``; ``removed``, the maximal [from, to) word
    intervals; ``left``, the text without them, its other white space untouched; ``kept``, the words left
    joined by one space; ``kept_sha256`` of that in UTF-8.

    Nulls and edges: a null or empty text has no words; texts shorter than a window keep all; a null
    id comes after all others, and rows with equal ids never remove each other's words; repetition
    within one document stays. Ids are integers. Columns that are not carried are not
    read, and columns may have any names.
    """
    rows = docs.select(
        F.coalesce(F.col(id).cast("long"), F.lit(_LAST)).alias("id"),
        F.col(id).alias("own_id"),
        F.col(text).alias("text"),
        *(F.col(f"`{name}`").alias(f"carried_{i}") for i, name in enumerate(carried)),
    )
    buckets = 1 + text_bytes(docs, text) // BUCKET_BYTES
    answers = (
        rows.select("id", "text")
        .mapInArrow(
            _first_seen(length, buckets),
            "bucket long, block string, ids binary, values binary, docs binary, again binary, again_docs binary",
        )
        .groupBy("bucket")
        .applyInArrow(thrifty(_answered), "block string, values binary, ids binary")
        .groupBy("block")
        .applyInArrow(thrifty(_by_document), "id long, values binary")
        .groupBy("id")
        .agg(F.collect_list("values").alias("values"))
    )
    kinds = {"n_words": "long", "n_removed": "long", "removed": "array<array<bigint>>", "left": "string", "kept": "string", "kept_sha256": "string"}
    own = ["own_id", *(f"carried_{i}" for i in range(len(carried)))]
    names = [*own, *outputs]
    fields = [f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in own]
    ddl = ", ".join([*fields, *(f"{n} {kinds[n]}" for n in outputs)])
    return (
        rows.join(answers, "id", "left")
        .select(*(f"`{name}`" for name in own), "text", "values")
        .mapInArrow(_cut(length, names, to_arrow_schema(StructType.fromDDL(ddl))), ddl)
        .toDF(id, *carried, *outputs)
    )


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents without the 13-word passages of earlier ones, as digests."""
    return remove_repeats(table(spark, sf_dir, "documents"), outputs=("n_words", "n_removed", "kept_sha256"))


QUERIES = {"op8_substring_dedup": op8_substring_dedup}
