"""BPE encoding through a table of distinct words, and decoding through a table of pieces.

A map task cuts its documents into blocks of a few megabytes. The distinct words of each block are dealt
by hash into buckets; a bucket encodes each of its distinct words once and answers every block with the
ids of its words, in the order asked. A second reading of the documents gives the number of the word at
every position of a block, where the ids are then put. A word in every document is sent once for each
block, so no bucket depends on how frequent a word is.

Blocks are named by input partition, place in it and content. Both readings, and a task that runs again,
must therefore see the rows of a partition in one order, as files give them; otherwise the job fails.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from townads.llm.frames import table, text_bytes
from townads.llm.vocabulary import Encoder, pieces, shipped, splits_at_spaces
from townads.llm.words import buffers, parts, thrifty

BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
MAX_PIECES = 1 << 20
_WORDS = "bucket long, block string, words binary"
_PART = "block string, bucket long, n long, sizes binary, tokens binary, places binary, rows binary, ids binary"


class _Numbers(dict):
    """Words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _press(x: np.ndarray | bytes) -> bytes:
    return zstandard.compress(x if isinstance(x, bytes) else np.ascontiguousarray(x).tobytes(), 3)


def _plain(x: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(x), kind)


def _arrow(rows: list[tuple], ddl: str) -> pa.Table:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = pa.schema([(name, kinds[kind]) for name, kind in map(str.split, ddl.split(", "))])
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)


class _Block(NamedTuple):
    """Some documents: their distinct words, sorted within buckets, and the bucket of each."""

    name: str
    ids: pa.Array
    split: list[list[bytes]]
    words: list[bytes]
    bucket: np.ndarray


def _blocks(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[_Block]:
    own = TaskContext.get().partitionId()
    for n, rows in enumerate(part for batch in batches for part in parts(batch, "text", BLOCK_BYTES)):
        data, offsets = buffers(rows["text"])
        raw = memoryview(data)
        split = [bytes(raw[a:b]).split() for a, b in zip(offsets[:-1], offsets[1:])]
        words = sorted(set(chain.from_iterable(split)))
        bucket = np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in words), np.int64, len(words))
        order = np.argsort(bucket, kind="stable")
        name = f"{own}-{n}-{xxhash.xxh3_64_hexdigest(raw[offsets[0] : offsets[-1]])}"
        yield _Block(name, rows["id"].combine_chunks(), split, [words[i] for i in order.tolist()], bucket[order])


def _asked(buckets: int) -> Callable:
    """The words of each block by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, buckets):
            bucket = block.bucket
            cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
            out = [
                (int(bucket[low]), block.name, _press(b"\n".join(block.words[low:high])))
                for low, high in zip(cuts, [*cuts[1:], len(bucket)])
            ]
            yield from _arrow(out, _WORDS).to_batches(max_chunksize=64)

    return run


def _placed(buckets: int) -> Callable:
    """The number of the word at each position of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, buckets):
            numbers = dict(zip(block.words, range(len(block.words))))
            sizes = np.array([len(x) for x in block.split], dtype=np.int32)
            places = np.fromiter(map(numbers.__getitem__, chain.from_iterable(block.split)), np.int32, int(sizes.sum()))
            planes = places.view(np.uint8).reshape(-1, 4).T  # the high bytes are mostly zero
            known = np.array(block.ids.is_valid()).astype(np.int64)
            ids = np.concatenate([known, np.array(block.ids.fill_null(0), dtype=np.int64)])
            out = [(block.name, None, len(numbers), None, None, _press(planes), _press(sizes), _press(ids))]
            yield from _arrow(out, _PART).to_batches()

    return run


def _encoded(model: Broadcast) -> Callable:
    held: list[Encoder] = []  # one for all groups of a task

    def run(group: pa.Table) -> pa.Table:
        asked = [(r["block"], r["bucket"], zstandard.decompress(r["words"]).split(b"\n")) for r in group.to_pylist()]
        seen = _Numbers()
        numbers = [np.fromiter(map(seen.__getitem__, words), np.int32, len(words)) for *_, words in asked]
        if not held:
            held.append(Encoder(model))
        ids = held[0].ids([w.decode() for w in seen])
        sizes = np.fromiter(map(len, ids), np.int32, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        out = [
            (block, bucket, len(n), _press(sizes[n]), _press(flat[_ranges(starts[n], sizes[n])]), None, None, None)
            for (block, bucket, _), n in zip(asked, numbers)
        ]
        return _arrow(out, _PART)

    return run


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start+1, ... of each size, one after the other."""
    ends = np.cumsum(sizes, dtype=np.int64)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _sha(texts: pa.Array) -> pa.Array:
    data, offsets = buffers(texts)
    raw = memoryview(data)
    return pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])], pa.string())


def _joined(parts_of: pa.Array, tokens: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Per document its tokens' texts joined by one space: a join of ids with the table of texts."""
    lists = pa.LargeListArray.from_arrays(pa.array(cuts, pa.int64()), parts_of.take(pa.array(tokens)))
    return pc.binary_join(lists, pa.scalar(" ", pa.large_string()))


def _assembled(vocabulary: Broadcast, outputs: tuple[str, ...], schema: pa.Schema) -> Callable:
    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        bases = [row for row in rows if row["places"] is not None]
        if len(bases) != 1 or bases[0]["n"] != sum(row["n"] for row in rows if row["places"] is None):
            raise RuntimeError("the documents came in another order when they were read again")
        base = bases[0]
        answers = sorted((row for row in rows if row["places"] is None), key=lambda row: row["bucket"])
        none = [np.zeros(0, dtype=np.int32)]
        sizes = np.concatenate([_plain(row["sizes"], np.int32) for row in answers] or none)
        flat = np.concatenate([_plain(row["tokens"], np.int32) for row in answers] or none)
        del rows, answers
        planes = _plain(base["places"], np.uint8)
        places = np.ascontiguousarray(planes.reshape(4, -1).T).view(np.int32).reshape(-1)
        n_words = _plain(base["rows"], np.int32)
        known, ids = np.split(_plain(base["ids"], np.int64), 2)
        tokens = flat[_ranges((np.cumsum(sizes) - sizes)[places], sizes[places])]
        cuts = np.concatenate([[0], np.cumsum(sizes[places])])[np.concatenate([[0], np.cumsum(n_words)])]
        table_of = vocabulary.value
        made = {"id": pa.array(ids, mask=known == 0), "n_tokens": pa.array(np.diff(cuts), pa.int64())}
        if "ids" in outputs:
            made["ids"] = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(tokens, pa.int32()))
        if "ids_sha256" in outputs:
            numbers = pa.array(map(str, range(len(table_of))), pa.large_string())
            made["ids_sha256"] = _sha(_joined(numbers, tokens, cuts))
        if "decoded" in outputs or "decoded_sha256" in outputs:
            decoded = _joined(pa.array(table_of, pa.large_string()), tokens, cuts)
            made |= {"decoded": decoded.cast(pa.string()), "decoded_sha256": _sha(decoded)}
        return pa.table([made[f.name] for f in schema], schema=schema)

    return run


_KINDS = {"n_tokens": "long", "ids": "array<int>", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}


def encode(
    docs: DataFrame,
    tokenizer: str,
    id: str = "doc_id",
    text: str = "text",
    outputs: tuple[str, ...] = ("n_tokens", "ids"),
) -> DataFrame:
    """The tokens of each row's text, as the tokenizers library gives them for the .json file
    ``tokenizer`` without adding special tokens, truncating or padding.

    Outputs to choose from: ``n_tokens``; ``ids``; ``decoded``, the ids turned back into text (for a
    model whose file names no decoder: the pieces joined by one space, special ones kept); and
    ``ids_sha256`` and ``decoded_sha256``, the hex digests of the decimal ids joined by one space and
    of the decoded text in UTF-8.

    Only models that never look across white space can be encoded word by word; others raise
    ValueError. Nulls and edges: a null text has no tokens and decodes to the empty text; ids are
    integers, may be null and may repeat, every row counts for itself; other columns are not read.
    """
    spark = docs.sparkSession
    model = shipped(spark, tokenizer)
    is_json, content = model.value
    if not is_json or not splits_at_spaces(content):
        raise ValueError(f"{tokenizer} looks across white space")
    ddl = ", ".join(["id long", *(f"{name} {_KINDS[name]}" for name in outputs)])
    buckets = 1 + text_bytes(docs, text) // BUCKET_BYTES
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    answers = rows.mapInArrow(_asked(buckets), _WORDS).groupBy("bucket").applyInArrow(thrifty(_encoded(model)), _PART)
    return (
        rows.mapInArrow(_placed(buckets), _PART)
        .union(answers)
        .groupBy("block")
        .applyInArrow(thrifty(_assembled(_pieces(spark, model), outputs, to_arrow_schema(StructType.fromDDL(ddl)))), ddl)
        .withColumnRenamed("id", id)
    )


def _pieces(spark: SparkSession, model: Broadcast) -> Broadcast:
    vocabulary = pieces(model)
    if len(vocabulary) > MAX_PIECES:
        raise ValueError(f"more than {MAX_PIECES} pieces")
    return spark.sparkContext.broadcast(vocabulary)


def decode(rows: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text of an array of ids: their pieces, found in the broadcast table of at most
    MAX_PIECES pieces, joined by one space. Null stays null, an empty array gives the empty text and
    an id that the model lacks fails the job."""
    vocabulary = _pieces(rows.sparkSession, shipped(rows.sparkSession, tokenizer))
    schema = StructType([*rows.schema.fields]).add(text, "string")
    fields = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_of = pa.array(vocabulary.value, pa.large_string())
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            lists = column.cast(pa.large_list(pa.int32()))
            taken = pa.LargeListArray.from_arrays(lists.offsets, table_of.take(lists.values))
            made = pc.binary_join(taken, pa.scalar(" ", pa.large_string())).cast(pa.string())
            made = pc.if_else(column.is_valid(), made, pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], schema=fields)

    return rows.mapInArrow(run, schema)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded, as digests."""
    return encode(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        outputs=("n_tokens", "ids_sha256", "decoded_sha256"),
    )


QUERIES = {"op5_bpe": op5_bpe}
