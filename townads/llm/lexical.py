"""Ranked lexical search: the documents with the largest inner products with each item's term weights.

A document is a sparse vector of impacts over the terms that any item has. As in LEMP, vectors are dealt
into buckets by their length (Euclidean norm), and an item meets a bucket in three steps, each with a bound
that no true result exceeds:

* Cauchy-Schwarz: item length times vector length, so short vectors, or whole buckets, are passed over;
* coordinates: the inner product over the item's heaviest terms, which is exact, plus Cauchy-Schwarz over
  the remaining coordinates of both;
* the survivors are scored again in 64-bit integers.

The bounds are compared with the least score that can still be among the best: of the longest vectors,
which are searched first, and of those met in the same bucket. Items come in blocks of bounded size,
each broadcast to all tasks; the documents meet them bucket by bucket, a large bucket in slices.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from townads.llm.frames import stored, table
from townads.llm.words import FOLDED, parts, words_of

BEST = 20
BATCH_BYTES = 3 << 20  # texts that a task looks at together; a longer text alone
BLOCK_TERMS = 1 << 19  # terms of the items that are broadcast together, about; a longer item alone
SLICE_TERMS = 1 << 20  # entries of vectors that a task searches together, about
OPENING = 16  # one document in so many, the longest vectors, is searched first
FOCUS = 0.6  # the terms outside of an item's focus have at most this share of its length
_SLACK = 1 + 1e-9  # of bounds in floating point
_LAST = (1 << 63) - 1  # stands for a missing id: such a row comes after all others
_DOCUMENTS, _TERMS = -1, -2  # what is counted besides document frequencies


class Items(NamedTuple):
    """A block of items: the terms of any of them, ascending, and of each item their places and numbers."""

    keys: list[int]
    terms: np.ndarray
    places: list[np.ndarray]
    often: list[np.ndarray]


class Scale(NamedTuple):
    """Weight of each term and what document lengths are measured by."""

    weights: np.ndarray
    documents: int
    length: int


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in (part for batch in batches for part in parts(batch, "text", BATCH_BYTES)):
        words = words_of(rows["text"], FOLDED)
        each = [words.prints[a:b].tobytes() for a, b in zip(words.first[:-1], words.first[1:])]
        yield from pa.table({"key": rows["key"], "prints": pa.array(each, pa.binary())}).to_batches()


def _block(rows: list) -> Items:
    prints = [np.frombuffer(row.prints, np.uint64) for row in rows]
    terms = np.unique(np.concatenate([*prints, np.zeros(0, np.uint64)]))
    found = [np.unique(p, return_counts=True) for p in prints]
    return Items([row.key for row in rows], terms, [np.searchsorted(terms, t) for t, _ in found], [n for _, n in found])


def _vectors(rows: pa.Table, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each row, and (row, term, occurrences) of every searched term in it, by row and term."""
    words = words_of(rows["text"], FOLDED)
    at = np.minimum(np.searchsorted(terms, words.prints), max(len(terms) - 1, 0))
    known = np.flatnonzero(terms[at] == words.prints) if len(terms) else np.zeros(0, np.int64)
    keys, often = np.unique(words.rows[known] * max(len(terms), 1) + at[known], return_counts=True)
    row, term = np.divmod(keys, max(len(terms), 1))
    return np.diff(words.first), row, term, often


def _frequencies(items: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = items.value.terms
        counts = np.zeros(len(terms), dtype=np.int64)
        documents = length = 0
        for rows in (part for batch in batches for part in parts(batch, "text", BATCH_BYTES)):
            n, _, term, _ = _vectors(rows, terms)
            counts += np.bincount(term, minlength=len(terms))
            documents, length = documents + int((n > 0).sum()), length + int(n.sum())
        names = np.append(np.flatnonzero(counts), [_DOCUMENTS, _TERMS])
        values = np.append(counts[counts > 0], [documents, length])
        yield from pa.table({"term": names, "n": values}).to_batches()

    return run


def _pressed(x: np.ndarray) -> bytes:
    return zstandard.compress(x.tobytes(), 1)


def _impacts(items: Broadcast, documents: int, length: int) -> Callable:
    """Per batch and bucket of lengths: ids, entries of each vector, their terms and impacts."""
    kinds = {"bucket": pa.int32(), "piece": pa.string(), "n_docs": pa.int64(), "n_terms": pa.int64()}
    kinds |= dict.fromkeys(("ids", "sizes", "terms", "impacts"), pa.binary())
    schema = pa.schema(list(kinds.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, n_piece = TaskContext.get().partitionId(), 0
        for rows in (part for batch in batches for part in parts(batch, "text", BATCH_BYTES)):
            n, row, term, often = _vectors(rows, items.value.terms)
            long = 75 + (25 * n.astype(np.int64) * documents) // max(length, 1)
            impact = (1_000_000_000 * often.astype(np.int64)) // (1000 * often + 12 * long[row])
            norms = np.sqrt(np.bincount(row, impact.astype(np.float64) ** 2, minlength=len(n)))
            with np.errstate(divide="ignore"):
                bucket = np.where(norms > 0, np.floor(2 * np.log2(norms)), -1).astype(np.int32)
            ids = rows["key"].to_numpy()
            sizes = np.bincount(row, minlength=len(n))
            out = []
            for b in np.unique(bucket[bucket >= 0]):
                mine, entries = bucket == b, bucket[row] == b
                columns = ids[mine], sizes[mine].astype(np.int32), term[entries].astype(np.int32), impact[entries].astype(np.int32)
                out.append((int(b), f"{own}-{n_piece}", int(mine.sum()), int(entries.sum()), *map(_pressed, columns)))
            n_piece += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def _unpacked(group: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.concatenate([np.frombuffer(zstandard.decompress(x.as_py()), kind) for x in group[name]])


def _search(items: Broadcast, weights: Broadcast, floors: Broadcast, best: int) -> Callable:
    """The best rows of a slice for each item, without those that cannot be among the best of all."""

    def run(group: pa.Table) -> pa.Table:
        ids, sizes = _unpacked(group, "ids", np.int64), _unpacked(group, "sizes", np.int32)
        terms, impacts = _unpacked(group, "terms", np.int32), _unpacked(group, "impacts", np.int32).astype(np.int64)
        first = np.append(0, np.cumsum(sizes, dtype=np.int64))
        rows = np.repeat(np.arange(len(ids)), sizes)
        squares = np.bincount(rows, impacts.astype(np.float64) ** 2, minlength=len(ids))
        # Vectors by length, longest first; the entries of each term in that order.
        longest = np.argsort(-squares, kind="stable")
        place = np.empty(len(ids), dtype=np.int64)
        place[longest] = np.arange(len(ids))
        squares = squares[longest]
        lengths = np.sqrt(squares)
        by_term = np.lexsort((place[rows], terms))
        bounds = np.searchsorted(terms[by_term], np.arange(len(weights.value) + 1))
        holders, held = place[rows[by_term]], impacts[by_term].astype(np.float64)
        dense = np.zeros(len(weights.value), dtype=np.int64)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for number, (places, often) in enumerate(zip(items.value.places, items.value.often)):
            exact = weights.value[places] * often
            heavy = np.argsort(-exact, kind="stable")
            places, exact = places[heavy], exact[heavy]
            rough = exact.astype(np.float64)
            tail = np.sqrt(np.append(np.cumsum(rough[::-1] ** 2)[::-1], 0.0))  # length of what follows
            floor = max(floors.value.get(number, 0), 1)
            reach = int(np.searchsorted(-lengths, -floor / (tail[0] * _SLACK), side="right")) if tail[0] else 0
            if not reach:
                continue
            focus = int(np.argmax(tail <= FOCUS * tail[0]))
            sums, seen = np.zeros(reach), np.zeros(reach)
            for t, w in zip(places[:focus], rough[:focus]):
                low, high = bounds[t], bounds[t + 1]
                high = low + np.searchsorted(holders[low:high], reach)
                sums[holders[low:high]] += w * held[low:high]
                seen[holders[low:high]] += held[low:high] ** 2
            if reach > best:  # what is known of a score already is at most the score
                floor = max(floor, np.partition(sums, reach - best)[reach - best] / _SLACK)
            rest = np.sqrt(np.maximum(squares[:reach] * _SLACK - seen, 0))
            left = np.flatnonzero((sums + tail[focus] * rest) * _SLACK >= floor)
            if not len(left):
                continue
            whose = longest[left]
            dense[places] = exact
            n = sizes[whose].astype(np.int64)
            start = np.cumsum(n) - n
            entries = np.repeat(first[whose] - start, n) + np.arange(int(n.sum()))
            scores = np.add.reduceat(dense[terms[entries]] * impacts[entries], start)
            dense[places] = 0
            top = np.lexsort((ids[whose], -scores))[:best]
            top = top[scores[top] > 0]
            out.append((np.full(len(top), number), ids[whose[top]], scores[top]))
        number, doc, score = (np.concatenate([np.zeros(0, np.int64), *column]) for column in zip(*out)) if out else [np.zeros(0, np.int64)] * 3
        return pa.table({"number": pa.array(number, pa.int32()), "doc": doc, "score": score})

    return run


def _ranked(found: DataFrame, best: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def _scale(docs: DataFrame, items: Broadcast) -> Scale:
    counted = docs.mapInArrow(_frequencies(items), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    known = dict(counted.collect())  # a row for each term of the block
    documents, length = known.pop(_DOCUMENTS, 0), known.pop(_TERMS, 0)
    weights = np.zeros(len(items.value.terms), dtype=np.int64)
    for term, n in known.items():
        weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1)))
    return Scale(weights, documents, length)


def _search_block(docs: DataFrame, block: Items, best: int) -> DataFrame:
    """Rows (key, rank, doc, score) of the items of a block."""
    spark = docs.sparkSession
    items = spark.sparkContext.broadcast(block)
    scale = _scale(docs, items)
    weights = spark.sparkContext.broadcast(scale.weights)
    packed = "bucket int, piece string, n_docs long, n_terms long, ids binary, sizes binary, terms binary, impacts binary"
    vectors = stored(docs.mapInArrow(_impacts(items, scale.documents, scale.length), packed), "impact-vectors")
    totals = vectors.groupBy("bucket").agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("m"))
    buckets = sorted(map(tuple, totals.collect()), reverse=True)  # a row for each half power of two
    slices = F.coalesce(*(F.when(F.col("bucket") == b, 1 + m // SLICE_TERMS) for b, _, m in buckets), F.lit(1))
    dealt = vectors.withColumn("slice", F.pmod(F.xxhash64("piece", "bucket"), slices))
    wanted, opened = sum(n for _, n, _ in buckets) / OPENING, 0
    bar = 0
    for b, n, _ in buckets:
        bar, opened = b, opened + n
        if opened >= wanted:
            break

    def searched(part: DataFrame, floors: dict[int, int]) -> DataFrame:
        run = _search(items, weights, spark.sparkContext.broadcast(floors), best)
        groups = part.groupBy("bucket", "slice").applyInArrow(run, "number int, doc long, score long")
        return _ranked(groups, best).drop("rank")

    longest = stored(searched(dealt.where(F.col("bucket") >= bar), {}), "best-of-longest")
    least = longest.groupBy("number").agg(F.min("score").alias("score"), F.count("*").alias("n")).where(F.col("n") == best)
    floors = {row.number: row.score for row in least.collect()}  # a row for each item of the block
    others = searched(dealt.where(F.col("bucket") < bar), floors)
    keys = spark.createDataFrame(list(enumerate(block.keys)), "number int, key long")
    ranked = _ranked(longest.union(others), best)
    return ranked.join(F.broadcast(keys), "number").select("key", "rank", "doc", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    best: int = BEST,
) -> DataFrame:
    """The ``best`` rows of ``docs`` for each item: (item, rank from 1, id, score), scores above 0 only.

    Terms are runs of ASCII letters and digits, A-Z lower-cased, and of all other characters above ASCII.
    With N rows that have terms, L terms in all, a row's n terms, df rows with a term and tf of its
    occurrences in a row, a term weighs ``floor(1000 ln((2N+2)/(2df+1)))``, a row's m is ``75 + 25nN div L``
    and its impact ``1e9 tf div (1000 tf + 12 m)``. A score sums weight times impact over the item's terms,
    repeats included. Equal scores go by ascending id.

    Nulls and edges: null and empty texts have no terms, such items get no rows and such rows do not count;
    a null id comes after all others; rows that share an id are ranked one by one; equal items (id and text) are
    searched once, items that share an id only are searched one by one; empty tables give no rows. Ids are
    integers. Terms are told apart by 64-bit values. Only the named columns are read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id).cast("long"), F.lit(_LAST)).alias("key"), F.col(text).alias("text"))
    asked = items.select(F.col(item).cast("long").alias("key"), F.col(item_text).alias("text")).distinct()
    prints = stored(asked.mapInArrow(_prints, "key long, prints binary").where(F.octet_length("prints") > 0), "items")
    n_blocks = 1 + (prints.agg(F.sum(F.octet_length("prints"))).first()[0] or 0) // (8 * BLOCK_TERMS)
    own = F.pmod(F.xxhash64("key", "prints"), F.lit(n_blocks))
    found = spark.createDataFrame([], "key long, rank int, doc long, score long")
    for n in range(n_blocks):
        block = _block(prints.where(own == n).collect())
        if block.keys:
            found = found.union(_search_block(rows, block, best))
    return found.select(
        F.col("key").alias(item),
        F.col("rank").alias("rank"),
        F.when(F.col("doc") != _LAST, F.col("doc")).alias(id),
        F.col("score").alias("score"),
    )


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of all for each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS_SQL = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_ORACLE = f"""
WITH d AS (SELECT doc_id, {_TERMS_SQL} AS terms FROM documents),
known AS (SELECT doc_id, terms, len(terms) AS n FROM d WHERE len(terms) > 0),
totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS length FROM known),
tf AS (SELECT doc_id, term, count(*) AS tf, any_value(n) AS n
       FROM (SELECT doc_id, n, unnest(terms) AS term FROM known) GROUP BY doc_id, term),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
            FROM tf, totals GROUP BY term, n_docs),
asked AS (SELECT item_id, term, count(*) AS often
          FROM (SELECT item_id, unnest({_TERMS_SQL}) AS term FROM benchmark) GROUP BY item_id, term),
scores AS (
    SELECT item_id, doc_id,
           sum(often * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // length))))::BIGINT AS score
    FROM asked JOIN tf USING (term) JOIN weights USING (term), totals GROUP BY item_id, doc_id
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM scores WHERE score > 0)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM ranked WHERE r <= {BEST}"""

QUERIES = {"op13_lexical_search": op13_lexical_search}
ORACLE = {"op13_lexical_search": _ORACLE}
