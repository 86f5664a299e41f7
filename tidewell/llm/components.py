"""Connected components of a distributed edge table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import materialize, materialize_keys

#: Edges that one task contracts by union-find.
BLOCK_EDGES = 1_000_000


def _contract(batches):
    """Union-find over the edges of a task: each node's edge to the least node it reaches there."""
    parts = [(np.array(b.column("u")), np.array(b.column("v"))) for b in batches if b.num_rows]
    if not parts:
        return
    a, b = (np.concatenate(x) for x in zip(*parts, strict=True))
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in zip(index[: len(a)].tolist(), index[len(a) :].tolist(), strict=True):
        i, j = root(i), root(j)
        if i != j:
            parent[max(i, j)] = min(i, j)
    top = np.array([root(i) for i in range(len(nodes))])
    moved = np.flatnonzero(top != np.arange(len(nodes)))
    for at in range(0, len(moved), 100_000):
        m = moved[at : at + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(nodes[m]), pa.array(nodes[top[m]])], names=["u", "v"])


def components(edges: DataFrame, a: str = "a", b: str = "b", block: int = BLOCK_EDGES) -> DataFrame:
    """(node, component) for every node with an edge to another; component is the least node it is connected with.

    Tasks of about ``block`` edges each contract them by union-find. Where more than one task is needed, a large-star and a
    small-star step between them (each node links its larger, then its smaller, neighbours to the least of them) bring
    the stars of the tasks together, until nothing changes. Loops, repeated edges and edges with a null end are ignored.
    Every step is written to the shared folder.
    """
    u, v = F.greatest(a, b), F.least(a, b)
    e = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(u.cast("long").alias("u"), v.cast("long").alias("v"))
    e = materialize_keys(e, "edges")
    before = None
    while True:
        n, now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        blocks = -(-n // block)
        if n == 0 or (n, now) == before:
            break
        before = (n, now)
        e = materialize(e.coalesce(max(1, blocks)).mapInArrow(_contract, "u long, v long"), "edges")
        if blocks <= 1:
            break
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize_keys(large.where(F.col("u") != F.col("v")).distinct(), "edges")
        # all edges now run from a node to a smaller one
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v")
        e = materialize_keys(small.where(F.col("u") != F.col("v")).distinct(), "edges")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
