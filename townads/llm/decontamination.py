"""Benchmark passages in training texts, found through a positional inverted index.

The index is cut by documents: a few megabytes of documents that a map task reads together are a shard with the
posting lists of all its tokens (sorted word positions, packed per bucket of tokens), so no posting
list grows beyond a shard, however frequent its token. The shards are a stored table. A query meets
every shard: the lists of its terms are shifted by their place in the phrase and intersected, from the
shard's rarest term on. Query phrases come in blocks of bounded size, each broadcast to the shards.

Tokens are known by 64-bit fingerprints. Positions of neighbouring documents are one apart from
consecutive, so no phrase crosses documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from townads.llm.frames import table
from townads.llm.words import FOLDED, parts, thrifty, words_of
from townads.session import scratch_folder

WINDOW = 13
TOKEN_BUCKETS = 16
SHARD_BYTES = 5 << 20  # texts of a shard; a longer text has one of its own
# Words of query phrases in one broadcast block: 8 bytes each, so at most 32 MB.
BLOCK_WORDS = 1 << 22
_INDEX = "shard string, bucket int, tokens binary, sizes binary, positions binary, ids binary, starts binary"
_DOCS = -1  # the bucket of a shard's list of documents


def _pack(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x).tobytes(), 3)


def _unpack(x: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(x), kind)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start+1, ... of each size, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int32(), *[pa.binary()] * 5]
    own = TaskContext.get().partitionId()
    for n, batch in enumerate(part for batch in batches for part in parts(batch, "text", size)):
        words = words_of(batch["text"], FOLDED)
        position = np.arange(len(words.prints)) + words.rows
        bucket = (words.prints & np.uint64(TOKEN_BUCKETS - 1)).astype(np.int8)
        order = np.argsort(words.prints, kind="stable")
        order = order[np.argsort(bucket[order], kind="stable")]
        prints, position, bucket = words.prints[order], position[order], bucket[order]
        starts = words.first + np.arange(len(words.first))
        ids = batch["id"].combine_chunks()
        name = f"{own}-{n}"  # the same when a lost task runs again
        out = [(name, _DOCS, None, None, None, _ids_packed(ids), _pack(starts))]
        cuts = np.searchsorted(bucket, np.arange(TOKEN_BUCKETS + 1))
        for k, (low, high) in enumerate(zip(cuts, cuts[1:])):
            if high > low:
                tokens, at = prints[low:high], position[low:high]
                new = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
                steps = np.diff(at, prepend=0)
                steps[new] = at[new]
                sizes = np.diff(np.append(new, len(tokens)))
                out.append((name, k, _pack(tokens[new]), _pack(sizes.astype(np.int32)), _pack(steps.astype(np.int32)), None, None))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), kinds)],
            names=["shard", "bucket", "tokens", "sizes", "positions", "ids", "starts"],
        )


def _ids_packed(ids: pa.Array) -> bytes:
    known = np.array(ids.is_valid())
    return _pack(np.concatenate([known.astype(np.int64), np.array(ids.fill_null(0), dtype=np.int64)]))


def build_index(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the positional index of all words of ``text`` to ``path`` and returns it as a frame.

    Words are runs of ASCII letters (lower-cased), digits and non-ASCII characters. A null text has
    no words; ids are integers and may be null or repeated, every row counts for itself.
    """
    docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        partial(_shards, size=SHARD_BYTES), _INDEX
    ).write.mode("overwrite").parquet(path)
    return docs.sparkSession.read.schema(_INDEX).parquet(path)


class _Shard:
    """The posting lists of one shard, of the tokens that a block of phrases has."""

    def __init__(self, group: pa.Table, wanted: np.ndarray):
        self.token = np.zeros(len(wanted), dtype=np.int64)  # size of the list of each wanted token
        self.lists: dict[int, np.ndarray] = {}
        if group["bucket"].to_pylist().count(_DOCS) != 1:
            raise ValueError(f"shard {group['shard'][0]} does not have one list of documents")
        for row in group.to_pylist():
            if row["bucket"] == _DOCS:
                self.starts = _unpack(row["starts"], np.int64)
                known, ids = np.split(_unpack(row["ids"], np.int64), 2)
                self.ids = pa.array(ids, mask=known == 0)
                continue
            tokens, sizes = _unpack(row["tokens"], np.uint64), _unpack(row["sizes"], np.int32).astype(np.int64)
            at = np.searchsorted(tokens, wanted)
            at[at == len(tokens)] = 0
            there = np.flatnonzero(tokens[at] == wanted)
            if not len(there):
                continue
            steps = _unpack(row["positions"], np.int32)
            ends = np.cumsum(sizes)
            for w, t in zip(there.tolist(), at[there].tolist()):
                self.token[w] = sizes[t]
                self.lists[w] = (steps, int(ends[t] - sizes[t]), int(ends[t]))

    def positions(self, w: int) -> np.ndarray:
        x = self.lists[w]
        if isinstance(x, tuple):
            steps, low, high = x
            x = self.lists[w] = np.cumsum(steps[low:high], dtype=np.int64)
        return x

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """First positions of a phrase: its lists, shifted, intersected from the rarest on."""
        order = np.argsort(self.token[terms], kind="stable").tolist()
        found = self.positions(int(terms[order[0]])) - order[0]
        for k in order[1:]:
            if not len(found):
                break
            other = self.positions(int(terms[k]))
            at = np.searchsorted(other, found + k)
            at[at == len(other)] = 0
            found = found[other[at] == found + k]
        return found

    def near(self, terms: np.ndarray, span: int) -> np.ndarray:
        """First positions of the stretches of ``span`` words, within one document, that hold every
        term, started at one of them. Only surroundings of the rarest term are looked at."""
        terms = np.unique(terms)
        rarest = self.positions(int(terms[np.argmin(self.token[terms])]))
        around = []
        for w in terms.tolist():
            x = self.positions(w)
            near = np.searchsorted(rarest, x)  # the next occurrence of the rarest term
            near[near == len(rarest)] = 0
            around.append(x[(rarest[near] >= x) & (rarest[near] < x + span)])
        starts = np.unique(np.concatenate(around))
        end = np.minimum(starts + span, self.starts[np.searchsorted(self.starts, starts, side="right")] - 1)
        for w in terms.tolist():
            x = self.positions(w)
            at = np.searchsorted(x, starts)
            good = (at < len(x)) & (x[np.minimum(at, len(x) - 1)] < end)
            starts, end = starts[good], end[good]
        return starts


def _matcher(block, span: int | None) -> Callable:
    def run(group: pa.Table) -> pa.Table:
        wanted, phrases, first, owner = block.value
        shard = _Shard(group, wanted)
        low = np.minimum.reduceat(np.append(shard.token, 0)[phrases], first[:-1]) if len(first) > 1 else np.zeros(0)
        starts, lengths, items = [], [], []
        for p in np.flatnonzero(low > 0).tolist():
            terms = phrases[first[p] : first[p + 1]]
            at = shard.phrase(terms) if span is None else shard.near(terms, span)
            starts.append(at)
            lengths.append(np.full(len(at), len(terms) if span is None else 1))
            items.append(np.full(len(at), p))
        none = np.zeros(0, dtype=np.int64)
        starts, lengths, items = (np.concatenate(x or [none]) for x in (starts, lengths, items))
        doc = np.searchsorted(shard.starts, starts, side="right") - 1
        order = np.lexsort((starts, doc))
        starts, lengths, items, doc = starts[order], lengths[order], items[order], doc[order]
        cuts = np.searchsorted(doc, np.arange(len(shard.ids) + 1))
        spans, owners = [None] * len(shard.ids), [None] * len(shard.ids)
        for d in np.unique(doc).tolist():
            part = slice(cuts[d], cuts[d + 1])
            s, e = starts[part] - shard.starts[d], starts[part] - shard.starts[d] + lengths[part]
            reach = np.maximum.accumulate(e)
            new = np.flatnonzero(np.append(True, s[1:] > reach[:-1]))
            spans[d] = np.stack([s[new], np.append(reach[new[1:] - 1], reach[-1])], axis=1).tolist()
            owners[d] = sorted({x for p in set(items[part].tolist()) for x in owner[p]})
        return pa.table(
            {
                "shard": pa.array([group["shard"][0].as_py()] * len(spans), pa.string()),
                "row": pa.array(range(len(spans)), pa.int64()),
                "id": shard.ids,
                "n_words": pa.array(np.diff(shard.starts) - 1, pa.int64()),
                "hits": pa.array([x or [] for x in spans], pa.list_(pa.list_(pa.int64()))),
                "items": pa.array([x or [] for x in owners], pa.list_(pa.int64())),
            }
        )

    return run


def _blocks(items: DataFrame, id: str, text: str, length: int | None) -> Iterator[tuple]:
    """Distinct phrases in blocks: the tokens, the phrases as numbers of tokens, where each begins, and
    which items each is in. ``length`` None takes a whole item as one phrase."""
    rows = items.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).where("id IS NOT NULL")
    phrases: dict[bytes, set[int]] = {}
    held = 0

    def block() -> tuple:
        made = [np.frombuffer(x, np.uint64) for x in phrases]
        first = np.cumsum([0, *map(len, made)])
        wanted, numbers = np.unique(np.concatenate(made or [np.zeros(0, np.uint64)]), return_inverse=True)
        return wanted, numbers.reshape(-1), first, [tuple(x) for x in phrases.values()]

    for row in rows.toLocalIterator():
        prints = words_of(pa.array([row["text"]], pa.string()), FOLDED).prints
        size = min(length or len(prints), len(prints))
        for at in range(len(prints) - size + 1 if size else 0):
            key = prints[at : at + size].tobytes()
            if key not in phrases:
                held += size
            phrases.setdefault(key, set()).add(row["id"])
            # A block may end inside an item: what its blocks find is put together afterwards.
            if held >= BLOCK_WORDS:
                yield block()
                phrases, held = {}, 0
    if phrases:
        yield block()


def find_phrases(
    index: DataFrame,
    items: DataFrame,
    id: str = "item_id",
    text: str = "text",
    length: int | None = WINDOW,
    span: int | None = None,
) -> DataFrame:
    """Where items occur in the indexed documents.

    Exact matches: the phrases of an item are its runs of ``length`` consecutive words; an item of
    fewer words, but not none, is one phrase, and with ``length=None`` every item is. With ``span``
    the match is by proximity: all words of a phrase in any order within ``span`` consecutive words
    of one document; its hit is the first word of such a stretch.

    One row for each indexed row: ``id``, ``n_words``, ``hits`` (the maximal [from, to) word intervals
    covered by matches), ``items`` (sorted ids of the items found). Items without an id or without
    words match nothing; equal phrases of several items count for each.
    """
    sc = index.sparkSession.sparkContext
    schema = "shard string, row long, id long, n_words long, hits array<array<bigint>>, items array<bigint>"
    found = [
        index.groupBy("shard").applyInArrow(thrifty(_matcher(sc.broadcast(block), span)), schema)
        for block in _blocks(items, id, text, length)
    ]
    if not found:
        none = np.zeros(0, dtype=np.int64)
        empty = (none.astype(np.uint64), none, np.zeros(1, dtype=np.int64), [])
        found = [index.groupBy("shard").applyInArrow(thrifty(_matcher(sc.broadcast(empty), span)), schema)]
    if len(found) == 1:
        return found[0].drop("shard", "row")
    both = (
        reduce(DataFrame.union, found)
        .groupBy("shard", "row", "id", "n_words")
        .agg(F.flatten(F.collect_list("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    )
    return both.select("id", "n_words", _merged(F.col("hits")).alias("hits"), "items")


def _merged(spans: Column) -> Column:
    """Overlapping or touching intervals as one."""
    nothing = F.array().cast("array<array<bigint>>")

    def step(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(
            F.slice(done, 1, F.size(done) - 1), F.array(F.array(last[0], F.greatest(last[1], x[1])))
        )
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))[1] >= x[0]), joined).otherwise(
            F.concat(done, F.array(x))
        )

    return F.aggregate(F.array_sort(spans), nothing, step)


def covered(hits: Column) -> Column:
    """Words in the intervals."""
    return F.aggregate(hits, F.lit(0).cast("long"), lambda n, x: n + x[1] - x[0])


def verdicts(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit, items and whether it is contaminated: at least a
    twentieth of its words lies in passages of items."""
    path = scratch_folder(docs.sparkSession, "postings")
    found = find_phrases(build_index(docs, path, id, text), items)
    n_hit = covered(F.col("hits"))
    return found.select(
        F.col("id").alias(id),
        "n_words",
        n_hit.alias("n_hit"),
        "items",
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of all documents by the benchmark."""
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        "contaminated",
    )


QUERIES = {"op1_decontamination": op1_decontamination}
