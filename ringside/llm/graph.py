"""Connected components of an edge table, in rounds that end when nothing changes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringside.session import cut, pieces_for

#: Edges that a task makes stars of at once: many, because each makes a row of nearly every node of a dense graph.
EDGES = 1 << 19


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node it can reach.

    A round begins in each task, which replaces its edges by stars of what they connect; a task has so many edges that
    few tasks repeat a node. Then the "large star" and
    "small star" steps hang every node's larger neighbours, then its smaller ones, below its smallest neighbour. A
    component of n nodes takes about log n rounds; every round but the last lowers some node's neighbours, so there is
    an end, and it is reached when every node hangs below one root. Each step groups by node with a partial minimum, so
    a node with many neighbours sends one row per task, and joins that minimum back (a join Spark can split when
    skewed). Each round is written to the shared folder: lineage stays short.
    """
    pairs = cut(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "edges")
    while edges := _unsettled(pairs):
        pairs = cut(_small_star(_large_star(_contracted(pairs, edges))), "edges")
    return pairs.select(F.col("b").alias("node"), F.col("a").alias("root")).union(pairs.select("a", "a").distinct())


def _unsettled(pairs: DataFrame) -> int:
    """0 where every node hangs once, and below a node that hangs nowhere; the number of edges otherwise."""
    ends = F.array(F.struct(F.col("a").alias("node"), F.lit(0).alias("hung"), F.lit(1).alias("roots")),
                   F.struct(F.col("b").alias("node"), F.lit(1).alias("hung"), F.lit(0).alias("roots")))
    nodes = pairs.select(F.inline(ends)).groupBy("node").agg(F.sum("hung").alias("hung"), F.max("roots").alias("roots"))
    got = nodes.agg(F.sum("hung").alias("edges"), F.max(F.expr("hung > 1 or hung = 1 and roots = 1")).alias("open")).first()
    return got["edges"] if got["open"] else 0


def _stars(batches):
    """Edges as stars around the smallest node of each component that the rows connect; some EDGES rows at a time."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= EDGES:
            yield _star(held)
            held, n = [], 0
    if n:
        yield _star(held)


def _star(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    a, b = (np.concatenate([x.column(c).to_numpy(zero_copy_only=False) for x in batches]) for c in (0, 1))
    nodes, places = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = places[:len(a)], places[len(a):]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        if np.array_equal(low, high):
            break
        np.minimum.at(root, high, low)
        while not np.array_equal(up := root[root], root):
            root = up
    hung = root != np.arange(len(nodes))
    return pa.RecordBatch.from_arrays([pa.array(nodes[root[hung]], pa.int64()), pa.array(nodes[hung], pa.int64())], ["a", "b"])


def _contracted(pairs: DataFrame, edges: int) -> DataFrame:
    return pairs.coalesce(pieces_for(edges, EDGES)).mapInArrow(_stars, "a bigint, b bigint")


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).union(pairs.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a <> b")


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("b").agg(F.min("a").alias("m"))
    moved = pairs.join(least, "b").select(F.col("m").alias("x"), F.col("a").alias("y")).filter("x <> y")
    return least.select("m", "b").union(moved).toDF("a", "b").distinct()
