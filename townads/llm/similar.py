"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Equal sets are one node. Candidates come from chosen paths over min-hashed sets of COORDINATES tokens
(coordinate, least hash of its part): each of RUNS runs splits all nodes by one token; a bucket of up to
SMALL nodes is compared by brute force on its sketches; a larger one is split again by the tokens at two
coordinates that its path selects, and what is still large after LEVELS is tied together as candidates, with
about one edge for a node. A pair at similarity 0.8 survives a run with probability 0.8 * 0.96 * 0.96 or more, so 12
runs miss it with probability 1e-7; pairs of one group support each other.

Candidates that hang together form groups. In a group every pair is compared exactly on the whole
shingle sets, in blocks of bounded size, so a group of any size is spread over tasks; pairs are counted,
never emitted. No bucket, group or text is cut or capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from townads.llm.frames import components, stored, table
from townads.llm.words import FOLDED, mixed, parts, rolling, thrifty, words_of

SHINGLE = 5
COORDINATES = 64
RUNS = 12
SMALL = 256
LEVELS = 3
#: Of the tokens of two sketches so many agree at least; at similarity 0.8 51 are expected, and fewer
#: than 34 are five standard deviations away.
AGREEING = 34
BLOCK_NODES, BLOCK_SHINGLES = 1000, 1 << 20
BATCH_BYTES = 3 << 20
_BITS = COORDINATES.bit_length() - 1
# For each coordinate the order in which it looks for a part that is not empty: itself first.
_ORDER = np.random.default_rng(7).random((COORDINATES, COORDINATES))
_ORDER[np.diag_indices(COORDINATES)] = -1
_NODES = "id long, key string, node binary, n long, paths array<bigint>, sketch binary"


def _sets(texts: pa.ChunkedArray) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each text; a text of fewer than five words is one shingle."""
    words = words_of(texts, FOLDED)
    for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        made = np.sort(rolling(words.prints[low:high], min(SHINGLE, high - low))) if high > low else words.prints[:0]
        yield made[np.append(True, made[1:] != made[:-1])] if len(made) else made


def _name(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _least(shingles: np.ndarray) -> np.ndarray:
    """The least hash of each of COORDINATES parts of the hash space; an empty part borrows another's."""
    bounds = np.arange(COORDINATES, dtype=np.uint64) << np.uint64(64 - _BITS)
    at = np.searchsorted(shingles, bounds)
    ends = np.append(at[1:], len(shingles))
    full = np.flatnonzero(at < ends)
    return shingles[at[full[np.argmin(_ORDER[:, full], axis=1)]]]


def _noded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in (part for batch in batches for part in parts(batch, "text", BATCH_BYTES)):
        nodes, sizes, paths, sketches = [], [], [], []
        for shingles in _sets(rows["text"]):
            sizes.append(len(shingles))
            if not len(shingles):
                nodes.append(None), paths.append(None), sketches.append(None)
                continue
            least = mixed(_least(shingles))
            nodes.append(_name(shingles))
            runs = np.arange(RUNS, dtype=np.uint64)
            paths.append(mixed(least[:RUNS] ^ (runs << np.uint64(56))).view(np.int64).tolist())
            sketches.append(least.astype(np.uint16).tobytes())
        yield from pa.table(
            {
                "id": rows["id"],
                "key": rows["key"],
                "node": pa.array(nodes, pa.binary()),
                "n": pa.array(sizes, pa.int64()),
                "paths": pa.array(paths, pa.list_(pa.int64())),
                "sketch": pa.array(sketches, pa.binary()),
            }
        ).to_batches()


def _linked(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the first row of its connected part."""
    label = np.arange(len(near))
    while True:
        new = np.minimum(label, np.where(near, label[None, :], len(near)).min(axis=1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges that hold together the similar nodes of each bucket, from the least node of each part; rows come in the
    order of buckets and nodes."""

    def edges(nodes: list[bytes], sketches: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        known = np.frombuffer(b"".join(sketches), np.uint16).reshape(len(nodes), COORDINATES)
        near = np.stack([(known == row).sum(axis=1) for row in known]) >= AGREEING
        for i, first in enumerate(_linked(near).tolist()):
            if first != i:
                yield nodes[first], nodes[i]

    path, nodes, sketches = None, [], []
    for batch in batches:
        found = []
        for p, node, sketch in zip(*(batch.column(c).to_pylist() for c in ("path", "node", "sketch"))):
            if p != path:
                if len(nodes) > 1:
                    found += edges(nodes, sketches)
                path, nodes, sketches = p, [], []
            nodes.append(node)
            sketches.append(sketch)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], names=["a", "b"])
    if len(nodes) > 1 and (found := list(edges(nodes, sketches))):
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], names=["a", "b"])


def _counted(rows: DataFrame) -> DataFrame:
    """Rows of buckets of at least two nodes, with the number of nodes."""
    sizes = rows.groupBy("path").count().where("count > 1")
    return rows.join(sizes, "path")


def _candidates(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) that hold together the nodes that may be similar."""
    rows = nodes.select(F.explode("paths").alias("path"), "node", "sketch")
    edges = None
    for level in range(1, LEVELS + 1):
        counted = stored(_counted(rows), "buckets")
        made = (
            counted.where(F.col("count") <= SMALL)
            .select("path", "node", "sketch")
            .repartition("path")
            .sortWithinPartitions("path", "node")
            .mapInArrow(_compared, "a binary, b binary")
        )
        edges = made if edges is None else edges.union(made)
        large = counted.where(F.col("count") > SMALL)
        if not large.limit(1).count():
            break
        if level < LEVELS:
            at = F.pmod(F.xxhash64("path", "branch"), F.lit(COORDINATES)).cast("int")
            rows = (
                large.select("path", "node", "sketch", F.explode(F.array(F.lit(0), F.lit(1))).alias("branch"))
                .withColumn("at", at)
                .select(F.xxhash64("path", "at", F.expr("substring(sketch, at * 2 + 1, 2)")).alias("path"), "node", "sketch")
            )
        else:
            least = large.groupBy("path").agg(F.min("node").alias("a"))
            edges = edges.union(large.join(least, "path").select("a", F.col("node").alias("b")))
    # A node is tied to the first of the least nodes that its buckets have given it, and these to each other, once for
    # all nodes that have the same ones: about one edge for a node, however many buckets it is in.
    tied = edges.where("a <> b").groupBy(F.col("b").alias("node")).agg(F.array_sort(F.collect_set("a")).alias("all"))
    tied = stored(tied.select("node", F.get("all", F.lit(0)).alias("a"), "all"), "chains")
    between = tied.select("a", F.explode("all").alias("b")).distinct()
    return tied.select("a", F.col("node").alias("b")).union(between).where("a <> b")


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingle set of each node that is asked for, from a row that has it; repeated rows come together."""
    last = None
    for rows in (part for batch in batches for part in parts(batch, "text", BATCH_BYTES)):
        asked = rows["node"].to_pylist()
        fresh = [node != before for node, before in zip(asked, [last, *asked])]
        last = asked[-1]
        rows = rows.filter(pa.array(fresh))
        made = [s.tobytes() for s in _sets(rows["text"])]
        yield from rows.drop_columns(["text"]).append_column("shingles", pa.array(made, pa.binary())).to_batches()


def _verified(similarity: float) -> Callable:
    """Within a block, or between two, the number of documents that each node links to. Also, within a block, the first
    node of its connected part; between two, for the first node of a part that lies in one block, the first of the
    part that both blocks make, and for others the node itself."""
    per = 1000
    threshold = round(similarity * per)

    def run(group: pa.Table) -> pa.Table:
        # A node can come from several rows that are equal.
        rows = {row["node"]: row for row in group.to_pylist()}
        nodes = sorted(rows)
        made = [np.frombuffer(rows[node]["shingles"], np.uint64) for node in nodes]
        sizes = np.array([len(x) for x in made])
        owner = np.repeat(np.arange(len(nodes)), sizes)
        shingles = np.concatenate(made)
        order = np.argsort(shingles, kind="stable")
        shingles, owner = shingles[order], owner[order]
        column = np.cumsum(np.append(0, shingles[1:] != shingles[:-1]))
        shared = np.bincount(column) > 1
        keep = shared[column]
        owner, column = owner[keep], (np.cumsum(shared) - 1)[column[keep]]
        both = np.zeros((len(nodes), len(nodes)), dtype=np.int64)
        for low in range(0, int(shared.sum()), 4096):
            a, b = np.searchsorted(column, (low, low + 4096))
            has = np.zeros((len(nodes), 4096), dtype=np.float32)
            has[owner[a:b], column[a:b] - low] = 1
            both += np.rint(has @ has.T).astype(np.int64)
        near = both * per >= (sizes[:, None] + sizes[None, :] - both) * threshold
        block = np.array([rows[node]["block"] for node in nodes])
        low, high = rows[nodes[0]]["low"], rows[nodes[0]]["high"]
        np.fill_diagonal(near, False)
        first = _linked(near)
        if low != high:
            # What is linked within a block is tied together there, so its first node stands for all of it.
            across = block[:, None] != block[None, :]
            own = np.arange(len(nodes))
            first = np.where(_linked(near & ~across) == own, first, own)
            near &= across
        copies = np.array([rows[node]["copies"] for node in nodes])
        return pa.table(
            {
                "node": pa.array(nodes, pa.binary()),
                "links": pa.array(near @ copies, pa.int64()),
                "first": pa.array([nodes[i] for i in first], pa.binary()),
                "alone": pa.array([rows[node]["blocks"] == 1 for node in nodes], pa.bool_()),
            }
        )

    return run


def near_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: id, ``class_id`` (the least id among the documents that links join to
    it over any number of steps, and its own), ``n_links`` (the other documents whose similarity to it
    is ``similarity`` or more, copies included), ``key`` (128 bits of id and text, which tell rows that
    share an id apart) and ``first``: whether the row has the least id, and then key, of its class.

    Words are runs of letters (ASCII ones lower-cased), digits and non-ASCII characters; a shingle is five
    of them; a text of one to four words is one shingle.

    Nulls and edges: texts without words are like no other and keep their own id as class; rows with a
    null id are compared like others, but do not name a class that has an id; rows that share an id are
    compared like others. Ids are integers; other columns are not read. An empty table gives no rows.
    """
    rows = docs.select(
        F.col(id).cast("long").alias("id"), row_key(id, text).alias("key"), F.col(text).alias("text")
    )
    every = stored(rows.mapInArrow(_noded, _NODES), "sets")
    nodes = stored(
        every.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.count("*").alias("copies"),
            F.min("id").alias("id"),
            F.min(_place()).alias("place"),
            F.first("n").alias("n"),
            F.first("paths").alias("paths"),
            F.first("sketch").alias("sketch"),
        ),
        "nodes",
    )
    groups = components(_candidates(nodes))
    members = groups.join(nodes.select("node", "copies", "place.key", "n"), "node")
    blocks = members.groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_NODES), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    asked = members.join(blocks, "component").withColumn("block", F.pmod(F.hash("node"), F.col("blocks")))
    found = (
        asked.join(rows.select("key", "text"), "key")
        .select("component", "node", "copies", "block", "blocks", "text")
        .mapInArrow(_whole, "component binary, node binary, copies long, block int, blocks int, shingles binary")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .groupBy("component", "low", "high")
        .applyInArrow(thrifty(_verified(similarity)), "node binary, links long, first binary, alone boolean")
    )
    found = stored(found, "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parted = components(found.where("NOT alone").select(F.col("node").alias("a"), F.col("first").alias("b")))
    classes = (
        found.where("alone")
        .select("node", F.col("first").alias("class"))
        .union(parted.select("node", F.col("component").alias("class")))
    )
    known = (
        nodes.select("node", "copies", F.col("id").alias("least"), "place")
        .join(links, "node", "left")
        .join(classes, "node", "left")
        .select(
            "node",
            F.coalesce("class", "node").alias("class"),
            "least",
            "place",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    named = known.groupBy("class").agg(F.min("least").alias("class_id"), F.min("place").alias("leading"))
    judged = known.join(named, "class").select("node", "class_id", "n_links", "leading")
    return (
        every.select("id", "key", "node")
        .join(judged, "node", "left")
        .select(
            F.col("id").alias(id),
            F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            "key",
            (F.col("node").isNull() | (_place() == F.col("leading"))).alias("first"),
        )
    )


def row_key(id: str, text: str) -> Column:
    """128 bits of id and text, as text."""
    own, content = F.col(id).cast("long"), F.col(text)
    return F.concat_ws(" ", F.xxhash64(own, content), F.xxhash64(F.lit(1), content, own))


def _place() -> Column:
    """Orders rows by id, those without one last, and then by key."""
    return F.struct(F.col("id").isNull().alias("late"), F.coalesce("id", F.lit(0)).alias("id"), F.col("key").alias("key"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near copies among all documents and the number of links of each."""
    return near_copies(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


QUERIES = {"op3_ngram_join": op3_ngram_join}
