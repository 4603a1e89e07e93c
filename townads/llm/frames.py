"""Small helpers on DataFrames that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from townads.session import scratch_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read again; this cuts its lineage."""
    path = scratch_folder(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def text_bytes(docs: DataFrame, text: str) -> int:
    """Bytes of all texts."""
    return docs.select(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): rows (node, component), the component being its least node.

    Each round every node moves to the first of its neighbours and itself, in the order of a hash, and from there
    on to the first of that one's; edges between what the nodes have moved to are all that the next round reads. So
    rounds grow with the logarithm of the number of nodes, for chains, too, and all rounds together join about twice
    the edges. Minima combine before the shuffle; each round is stored in the shared folder, and only whether edges
    are left reaches the driver. No edges give no rows.
    """
    left = stored(_undirected(edges, "a", "b"), "edges")
    levels = []
    while not levels or left.limit(1).count():
        turned = F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
        first = (
            left.select(F.inline(F.array(F.struct("a", "b"), turned)))
            .groupBy("a")
            .agg(F.min(_hashed("b")).alias("first"))
            .select(F.col("a").alias("node"), F.least(_hashed("a"), "first")["node"].alias("up"))
        )
        up = first.select(F.col("node").alias("up"), F.col("up").alias("top"))
        moved = stored(first.join(up, "up").select("node", F.col("top").alias("up")), "moved")
        levels.append(moved)
        of_a = moved.select(F.col("node").alias("a"), F.col("up").alias("up_a"))
        of_b = moved.select(F.col("node").alias("b"), F.col("up").alias("up_b"))
        left = stored(_undirected(left.join(of_a, "a").join(of_b, "b"), "up_a", "up_b"), "edges")
    # Back from the last round to the first: where a node has moved to in the end.
    ends = levels.pop()
    for moved in reversed(levels):
        end = ends.select(F.col("node").alias("up"), F.col("up").alias("end"))
        ends = moved.join(end, "up", "left").select("node", F.coalesce("end", "up").alias("up"))
    ends = stored(ends, "ends")
    least = ends.groupBy("up").agg(F.min("node").alias("component"))
    return stored(ends.join(least, "up").select("node", "component"), "labels")


def _undirected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Each edge once, without loops."""
    return edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _hashed(node: str) -> Column:
    """Orders nodes by a hash, so that no numbering of them makes long descents."""
    return F.struct(F.xxhash64(node).alias("hash"), F.col(node).alias("node"))
