"""Approximate nearest neighbours by cosine: a neighbour graph by NN-descent, then greedy search on it.

The graph starts from random hyperplane codes: points with one code are compared with each other. In
each round every point brings its neighbours, and a sample of the points that have it as a neighbour,
together: these are neighbours of neighbours, compared with each other by brute force unless both are known from
the round before; what is nearer than what a point has is proposed to it. Rounds end when at most SETTLED of all
neighbours are new. Vectors travel as 16-bit integers for this, exact ones decide in
the search. Equal vectors are one point of the graph, which knows the smallest ids of its copies; what is
equal in 16 bits only is kept in an order that each point draws anew, so no part of a dense group is cut
off from the others. A search keeps the BEAM nearest points seen and follows the neighbours of the nearest ones
not followed yet, a join for each step, until the nearest are all followed.

Groups are bounded: codes with many points are split by hash, a point has DEGREE neighbours, and of the
points that have it as one, at most SAMPLED take part in a round (drawn first by slices of a hash, so a point
near a third of all others is no burden); these always meet it in their own group as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from townads.llm.frames import stored, table

NEIGHBOURS = 5
DEGREE = 32
CODES, CODE_POINTS = 12, 256
SETTLED = 0.15
SAMPLED = 16
BEAM, FOLLOWED = 96, 48
# Neighbours, nearest first, their similarities, and which of them are new and how many.
_LISTS = "id long, near binary, far binary, fresh binary, n_fresh int"
_HELD = 1 << 21
_SEED = 20240207


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _within(v: np.ndarray) -> np.ndarray:
    """The vector times a power of two that brings its largest component near 1, so that no square of it
    overflows or vanishes; the cosine stays the same to the last bit."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=-1, keepdims=True))[1])


def _pointed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Points whose vector can be compared, with the vector as it is given (but no negative zeros)."""
    for batch in batches:
        ids, exact = [], []
        for i, x in zip(batch.column(0).to_pylist(), batch.column(1)):
            if i is None or not x.is_valid:
                continue
            if x.values.null_count or not len(x.values):
                continue
            given = x.values.to_numpy() + 0
            v = given.astype(np.float64)
            if np.isfinite(v).all() and v.any():
                ids.append(i)
                exact.append(given.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(exact, pa.binary())], names=["id", "exact"])


def _scaled(kind: type) -> Callable:
    """Adds the direction of each vector, scaled to 16-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = [np.frombuffer(x, kind).astype(np.float64) for x in batch.column("exact").to_pylist()]
            coarse = [np.rint(_within(v) / np.abs(_within(v)).max() * 32767).astype(np.int16).tobytes() for v in given]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "exact", "members")), pa.array(coarse, pa.binary())],
                names=["id", "exact", "members", "coarse"],
            )

    return run


def _whole(column: list[bytes], kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.int16).reshape(len(column), -1).astype(kind)


def _drawn(points: np.ndarray, near: np.ndarray) -> np.ndarray:
    """A place for each neighbour among equally near ones, another order for each point."""
    mixed = near.astype(np.uint64) ^ (points.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return mixed * np.uint64(0xD6E8FEB86659FD93)


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[dict[str, list]]:
    """The rows of each key, which come one key after the other, as lists by column."""
    held: dict[str, list] | None = None
    for batch in batches:
        columns = batch.to_pydict()
        keys = columns[key]
        cuts = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]] + [len(keys)]
        for low, high in zip(cuts, cuts[1:]):
            part = {name: x[low:high] for name, x in columns.items()}
            if held is not None and held[key][0] == part[key][0]:
                held = {name: x + part[name] for name, x in held.items()}
            else:
                if held is not None:
                    yield held
                held = part
    if held is not None:
        yield held


class _Lists:
    """Proposals (point, neighbour, similarity), reduced to the nearest DEGREE of each point when many."""

    def __init__(self, size: int = DEGREE):
        self.size, self.parts, self.held = size, [], 0

    def add(self, points: np.ndarray, near: np.ndarray, far: np.ndarray, fresh: np.ndarray) -> None:
        self.parts.append((points.astype(np.int64), near.astype(np.int64), far.astype(np.float64), fresh.astype(np.bool_)))
        self.held += len(points)

    def packed(self) -> pa.RecordBatch:
        points, near, far, fresh = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((fresh, _drawn(points, near), -far, points))
        points, near, far, fresh = points[order], near[order], far[order], fresh[order]
        # The same neighbour always has the same similarity, so repetitions lie side by side, a known one first.
        new = np.append(True, (points[1:] != points[:-1]) | (near[1:] != near[:-1]))
        points, near, far, fresh = points[new], near[new], far[new], fresh[new]
        starts = np.flatnonzero(np.append(True, points[1:] != points[:-1]))
        rank = np.arange(len(points)) - np.repeat(starts, np.diff(np.append(starts, len(points))))
        keep = rank < self.size
        points, near, far, fresh = points[keep], near[keep], far[keep], fresh[keep]
        starts = np.flatnonzero(np.append(True, points[1:] != points[:-1]))
        ends = [*starts[1:], len(points)]
        self.parts, self.held = [], 0
        return pa.RecordBatch.from_arrays(
            [
                pa.array(points[starts], pa.int64()),
                pa.array([near[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                pa.array([far[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                pa.array([fresh[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                pa.array([int(fresh[a:b].sum()) for a, b in zip(starts, ends)], pa.int32()),
            ],
            names=["id", "near", "far", "fresh", "n_fresh"],
        )


def _coded(bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(_whole(batch.column("coarse").to_pylist(), np.float32))
            planes = np.random.default_rng(_SEED).standard_normal((CODES, x.shape[1], max(bits, 1))).astype(np.float32)
            powers = 1 << np.arange(bits, dtype=np.int64)
            for k in range(CODES):
                code = ((x @ planes[k])[:, :bits] > 0) @ powers if bits else np.zeros(len(x), dtype=np.int64)
                codes = pa.array(code * CODES + k, pa.int64())
                yield pa.RecordBatch.from_arrays([codes, batch.column("id"), batch.column("coarse")], names=["code", "id", "coarse"])

    return run


def _all_pairs(key: str) -> Callable:
    """Compares the points of each group with each other, but for two that are both not ``fresh``. A point that
    comes with ``least``, the similarity of its last neighbour, gets what is as near or nearer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = _Lists()
        for group in _runs(batches, key):
            ids = np.array(group["id"])
            known = ~np.array(group["fresh"], dtype=np.bool_) if "fresh" in group else np.zeros(len(ids), dtype=np.bool_)
            if len(ids) < 2 or known.all():
                continue
            x = _whole(group["coarse"], np.float64)
            far = x @ x.T  # sums of integers, so the same in every group
            norm = np.sqrt(np.diagonal(far))
            far = far / np.outer(norm, norm)
            far[np.ix_(known, known)] = -2
            np.fill_diagonal(far, -2)
            least = np.array(group["least"], dtype=np.float64) if "least" in group else np.full(len(ids), -1.5)
            size = min(DEGREE // 2 if "least" in group else DEGREE, len(ids) - 1)
            best = np.argpartition(-far, size - 1, axis=1)[:, :size]
            value = np.take_along_axis(far, best, axis=1)
            row, column = np.nonzero(value >= least[:, None])
            lists.add(ids[row], ids[best[row, column]], value[row, column], np.ones(len(row)))
            if lists.held > _HELD:
                yield lists.packed()
        if lists.held:
            yield lists.packed()

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lists = _Lists()
    for group in _runs(batches, "id"):
        near, far, fresh = (np.frombuffer(b"".join(group[x]), t) for x, t in (("near", np.int64), ("far", np.float64), ("fresh", np.bool_)))
        lists.add(np.full(len(near), group["id"][0]), near, far, fresh)
        if lists.held > _HELD:
            yield lists.packed()
    if lists.held:
        yield lists.packed()


def _unpacked(lists: DataFrame) -> DataFrame:
    """Rows (id, other, fresh) of the neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
            ids = np.repeat(batch.column(0).to_numpy(), [len(x) for x in near])
            fresh = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.bool_)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(np.concatenate(near or [ids]), pa.int64()), pa.array(fresh, pa.bool_())],
                names=["id", "other", "fresh"],
            )

    return lists.select("id", "near", "fresh").mapInArrow(run, "id long, other long, fresh boolean")


def _least(lists: DataFrame) -> DataFrame:
    """Similarity of the last neighbour; a list that is not full yet takes anything."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = [np.frombuffer(x, np.float64) for x in batch.column(1).to_pylist()]
            least = [float(x[-1]) if len(x) == DEGREE else -1.5 for x in far]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(least, pa.float64())], names=["id", "least"])

    return lists.select("id", "far").mapInArrow(run, "id long, least double")


def _sampled(edges: DataFrame, round_: int) -> DataFrame:
    """At most SAMPLED of the rows (id, other, fresh) of each id, new ones first, chosen by hash, first within slices."""
    drawn = edges.withColumn("draw", F.xxhash64("other", F.lit(round_)))
    order = [F.desc("fresh"), "draw", "other"]
    slices = Window.partitionBy("id", F.pmod("draw", F.lit(64))).orderBy(*order)
    first = drawn.withColumn("n", F.row_number().over(slices)).where(F.col("n") <= SAMPLED)
    whole = Window.partitionBy("id").orderBy(*order)
    return first.withColumn("n", F.row_number().over(whole)).where(F.col("n") <= SAMPLED).select("id", "other", "fresh")


def _known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists whose neighbours have all met."""
    for batch in batches:
        met = [bytes(len(x)) for x in batch.column("fresh").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("id", "near", "far")), pa.array(met, pa.binary()), pa.array([0] * len(met), pa.int32())],
            names=["id", "near", "far", "fresh", "n_fresh"],
        )


def build_graph(points: DataFrame, settled: float = SETTLED) -> DataFrame:
    """The DEGREE neighbours of every point (rows id, coarse): packed lists, nearest first. Lists only get nearer,
    so the rounds come to an end with any ``settled`` from 0."""
    n = points.count()
    bits = max(0, int(np.log2(max(n, 1) / CODE_POINTS)))
    coded = points.select("id", "coarse").mapInArrow(_coded(bits), "code long, id long, coarse binary")
    parts = stored(coded.groupBy("code").agg(F.ceil(F.count("*") / (2 * CODE_POINTS)).alias("slices")), "codes")
    lists = (
        coded.join(parts, "code")
        .select(F.xxhash64("code", F.pmod(F.xxhash64("id", "code"), "slices")).alias("code"), "id", "coarse")
        .repartition("code")
        .sortWithinPartitions("code")
        .mapInArrow(_all_pairs("code"), _LISTS)
    )
    lists = stored(lists.repartition("id").sortWithinPartitions("id").mapInArrow(_merged, _LISTS), "graph")
    for k in count():
        n_fresh, n_all = lists.agg(F.sum("n_fresh"), F.sum(F.octet_length("fresh"))).first()
        if not n_fresh or n_fresh <= settled * n_all:
            return lists
        edges = _unpacked(lists)
        back = _sampled(edges.select(F.col("other").alias("id"), F.col("id").alias("other"), "fresh"), k)
        members = (
            edges.union(back).groupBy(F.col("id").alias("centre"), F.col("other").alias("id")).agg(F.max("fresh").alias("fresh"))
        )
        known = points.select("id", "coarse").join(_least(lists), "id")
        proposed = (
            members.join(known, "id")
            .repartition("centre")
            .sortWithinPartitions("centre")
            .mapInArrow(_all_pairs("centre"), _LISTS)
        )
        met = lists.mapInArrow(_known, _LISTS)
        lists = stored(
            proposed.union(met).repartition("id").sortWithinPartitions("id").mapInArrow(_merged, _LISTS), "graph"
        )


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nearest points of each query that are not followed yet."""
    for batch in batches:
        query, node = [], []
        for q, beam, done in zip(*(batch.column(c).to_pylist() for c in ("query", "beam", "done"))):
            beam, done = np.frombuffer(beam, np.int64), np.frombuffer(done, np.bool_)
            new = beam[~done][:FOLLOWED]
            query += [q] * len(new)
            node += new.tolist()
        yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(node, pa.int64())], names=["query", "id"])


def _unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the points that each query has found those that it has not compared with yet."""
    query, node = [], []
    for group in _runs(batches, "query"):
        seen = np.frombuffer(next(x for x in group["seen"] if x is not None), np.int64)
        found = np.array([i for i, x in zip(group["id"], group["seen"]) if x is None], dtype=np.int64)
        found = found[~np.isin(found, seen)]
        query.append(np.full(len(found), group["query"][0]))
        node.append(found)
    if query:
        columns = [pa.array(np.concatenate(x), pa.int64()) for x in (query, node)]
        yield from pa.table(columns, names=["query", "id"]).to_batches(max_chunksize=65536)


def _stepped(kind: type) -> Callable:
    return lambda batches: _steps(batches, kind)


def _steps(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[pa.RecordBatch]:
    """The beams with what the points found add to them; a query's beam and its finds come together."""
    out = []
    names = ["query", "exact", "beam", "scores", "done", "seen", "open"]
    kinds = [pa.int64(), *[pa.binary()] * 5, pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    for group in _runs(batches, "query"):
        at = next(i for i, x in enumerate(group["beam"]) if x is not None)
        query = group["query"][0]
        v = _within(np.frombuffer(group["exact"][at], kind).astype(np.float64))
        seen = np.frombuffer(group["seen"][at], np.int64)
        beam, scores = np.frombuffer(group["beam"][at], np.int64), np.frombuffer(group["scores"][at], np.float64)
        done = np.frombuffer(group["done"][at], np.bool_).copy()
        done[np.flatnonzero(~done)[:FOLLOWED]] = True
        found = [i for i, x in enumerate(group["beam"]) if x is None]
        if found:
            ids = np.array([group["id"][i] for i in found], dtype=np.int64)
            x = np.frombuffer(b"".join(group["exact"][i] for i in found), kind).reshape(len(ids), -1).astype(np.float64)
            x = _within(x)
            score = x @ v / (np.linalg.norm(x, axis=1) * np.linalg.norm(v))
            beam, scores, seen = np.append(beam, ids), np.append(scores, score), np.append(seen, ids)
            done = np.append(done, ids == query)
            order = np.lexsort((beam, -scores))[:BEAM]
            beam, scores, done = beam[order], scores[order], done[order]
        left = int((~done[: BEAM // 2]).sum())
        out.append((query, group["exact"][at], beam.tobytes(), scores.tobytes(), done.tobytes(), seen.tobytes(), left))
        if len(out) == 256:
            yield batch_of(out)
            out = []
    if out:
        yield batch_of(out)


_STATE = "query long, exact binary, beam binary, scores binary, done binary, seen binary, open long"


def search(points: DataFrame, graph: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, kind: type = np.float64) -> DataFrame:
    """Greedy search: for each of ``queries`` (ids of points) the ``k`` nearest points found, itself included,
    as rows (query, score, members); score is the cosine in double precision, ties go to the smaller id of a point.
    ``kind`` is the type of the components in ``exact``."""
    start = points.join(queries.select("id").distinct(), "id")
    nothing = F.lit(b"")
    # A query is a point of the graph: its search starts there.
    state = start.select(
        F.col("id").alias("query"), "exact", nothing.alias("beam"), nothing.alias("scores"), nothing.alias("done"), nothing.alias("seen"), F.lit(1).cast("long").alias("open")
    )
    steps = own_point = start.select(F.col("id").alias("query"), "id")
    for n in count():
        reached = _unpacked_for(steps, graph)
        met = (reached if n else reached.union(own_point)).distinct().select("query", "id", F.lit(None).cast("binary").alias("seen"))
        old = state.select("query", F.lit(None).cast("long").alias("id"), "seen")
        found = (
            met.union(old)
            .repartition("query")
            .sortWithinPartitions("query")
            .mapInArrow(_unseen, "query long, id long")
            .join(points.select("id", "exact"), "id")
            .select("query", "id", "exact", F.lit(None).cast("binary").alias("beam"), F.lit(None).cast("binary").alias("scores"), F.lit(None).cast("binary").alias("done"), F.lit(None).cast("binary").alias("seen"))
        )
        own = state.select("query", F.lit(None).cast("long").alias("id"), "exact", "beam", "scores", "done", "seen")
        state = stored(
            own.union(found).repartition("query").sortWithinPartitions("query").mapInArrow(_stepped(kind), _STATE), "beams"
        )
        if not state.where("open > 0").limit(1).count():
            break  # every query has followed the nearest half of its beam
        steps = state.where("open > 0").select("query", "beam", "done").mapInArrow(_followed, "query long, id long")

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for q, beam, scores in zip(*(batch.column(c).to_pylist() for c in ("query", "beam", "scores"))):
                rows += [(q, int(i), float(s)) for i, s in zip(np.frombuffer(beam, np.int64)[:k], np.frombuffer(scores, np.float64))]
            columns = zip(*rows) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.float64()])], names=["query", "id", "score"]
            )

    return (
        state.select("query", "beam", "scores")
        .mapInArrow(nearest, "query long, id long, score double")
        .join(points.select("id", "members"), "id")
        .select("query", "score", "members")
    )


def _unpacked_for(steps: DataFrame, graph: DataFrame) -> DataFrame:
    """The neighbours (query, id) of the points that queries follow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
            query = np.repeat(batch.column(0).to_numpy(), [len(x) for x in near])
            yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(np.concatenate(near or [query]), pa.int64())], names=["query", "id"])

    return steps.join(graph.select("id", "near"), "id").select("query", "near").mapInArrow(run, "query long, id long")


def nearest(vectors: DataFrame, queries: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = NEIGHBOURS) -> DataFrame:
    """For each row of ``queries`` (a column ``id`` of ids among ``vectors``) its ``k`` nearest neighbours.

    Rows whose id or vector is null, or whose vector is empty, zero or holds a null or non-finite
    component take no part, neither as query nor as candidate; neither do ids that ``vectors`` lacks, nor
    vectors of another length than most have (of lengths that are as common, the shorter counts). Equal vectors tie,
    and ties go to the smaller id. Repeated rows count once. An id with several vectors is as near as the nearest two of
    its and the other's vectors, and comes once in a result. With fewer than ``k`` candidates all are returned; a
    single point has no neighbours and no row. Other columns are not read.
    """
    single = vectors.schema[vector].dataType.simpleString() == "array<float>"
    given = F.col(vector) if single else F.col(vector).cast("array<double>")
    kind = np.float32 if single else np.float64
    usable = vectors.select(F.col(id).cast("long").alias("id"), given.alias("v")).mapInArrow(_pointed, "id long, exact binary")
    usable = stored(usable, "vectors")
    # Equal vectors are told by 128 bits of hashes.
    key = [F.xxhash64("exact").alias("h1"), F.xxhash64(F.lit(1), "exact").alias("h2")]
    lengths = usable.groupBy(F.octet_length("exact").alias("bytes")).count().orderBy(F.desc("count"), "bytes").first()
    compared = usable.where(F.octet_length("exact") == (lengths.bytes if lengths else 0)).select("id", "exact", *key)
    ids = stored(compared.select("id", "h1", "h2").distinct(), "ids")
    several = ids.groupBy("id").count().where("count > 1").limit(1).count() > 0
    # A point has the smallest ids of its copies, and is numbered in the order of the smallest one.
    copies = Window.partitionBy("h1", "h2").orderBy("id")
    smallest = ids.withColumn("n", F.row_number().over(copies)).where(F.col("n") <= k + 1)
    members = smallest.groupBy("h1", "h2").agg(F.array_sort(F.collect_list("id")).alias("members"))
    nodes = stored(
        members.withColumn("first", F.col("members")[0])
        .repartitionByRange("first")
        .sortWithinPartitions("first", "h1", "h2")
        .withColumn("point", F.monotonically_increasing_id()),
        "nodes",
    )
    points = stored(
        compared.withColumnRenamed("id", "first")
        .join(nodes, ["h1", "h2", "first"])
        .dropDuplicates(["h1", "h2", "first"])
        .select(F.col("point").alias("id"), "exact", "members")
        .mapInArrow(_scaled(kind), "id long, exact binary, members array<bigint>, coarse binary"),
        "points",
    )
    asked = stored(
        ids.join(queries.select("id").distinct(), "id")
        .select(F.col("id").alias("query_id"), "h1", "h2")
        .join(nodes.select("h1", "h2", F.col("point").alias("query")), ["h1", "h2"])
        .select("query_id", "query"),
        "asked",
    )
    # Each of k + 1 points has a row, so no other point has one among the first k + 1; unless ids repeat.
    found = search(points, build_graph(points), asked.select(F.col("query").alias("id")), BEAM if several else k + 1, kind)
    rows = asked.join(found, "query").select("query_id", "score", F.explode("members").alias("id")).where("id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        rows.groupBy("query_id", "id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest neighbours of every fiftieth vector among all."""
    vectors = table(spark, sf_dir, "embeddings")
    queries = vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("id"))
    return nearest(vectors, queries).withColumnRenamed("id", "vec_id")


QUERIES = {"op9_nearest": op9_nearest}
