"""Connected components of an edge table: blocks contracted within tasks, then alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from epigauge.session import materialise


#: Edges that a task contracts at once; each is two numbers.
BLOCK = 500_000


def contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of some edges with the smallest node that can be reached over them."""
    nodes, place = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    root = np.arange(len(nodes))
    while True:
        one, other = root[a], root[b]
        apart = one != other
        if not apart.any():
            return nodes, nodes[root]
        a, b, one, other = a[apart], b[apart], one[apart], other[apart]
        least = np.minimum(one, other)
        np.minimum.at(root, one, least)
        np.minimum.at(root, other, least)
        while (root[root] != root).any():
            root = root[root]


def by_block(edges: DataFrame, n: int) -> DataFrame:
    """``u, v``: the edges of each block as stars, ``v`` the smallest node of a component; ``n`` is their number."""
    blocks = -(-n // BLOCK)

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def stars() -> pa.RecordBatch:
            u, v = (np.concatenate([h.column(c).to_numpy() for h in held]) for c in ("u", "v"))
            nodes, roots = contracted(u, v)
            far = nodes != roots
            return pa.RecordBatch.from_arrays([pa.array(nodes[far], pa.int64()), pa.array(roots[far], pa.int64())], ["u", "v"])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if blocks > 1 and size >= 2 * BLOCK:  # an uneven deal: some at a time, what is left to do follows
                yield stars()
                held, size = [], 0
        if size:
            yield stars()

    dealt = edges.repartition(1) if blocks == 1 else edges.repartition(blocks, "u", "v")
    return dealt.mapInArrow(contract, "u long, v long")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of ``edges`` (whole numbers); the root is the smallest node that can be reached.

    Blocks of edges are contracted to stars within tasks. If there is one block, that is all; else rounds follow, each of which
    points every node's neighbours at its smallest neighbour, first the larger ones, then the smaller ones. Sums are
    combined before every shuffle, so a node with very many edges is no burden. No edges give an empty table; null
    ends are ignored.
    """
    now = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).filter("u > v").distinct()
    seen = Observation()
    now = materialise(now.observe(seen, *changes()), "edges")
    n = seen.get["n"]
    if n <= BLOCK:
        return rooted(materialise(by_block(now, n), "roots") if n else now)
    seen = Observation()
    now = materialise(by_block(now, n).distinct().observe(seen, *changes()), "edges")
    known = seen.get
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        # Seen while it is written, without a job of its own: whether the table still changes.
        seen = Observation()
        now = materialise(small.observe(seen, *changes()), "edges")
        state = seen.get
        if state == known:
            break
        known = state
    return rooted(now)


def rooted(stars: DataFrame) -> DataFrame:
    """``node, root`` of stars, their centres included."""
    roots = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def changes() -> tuple[Column, Column]:
    return F.count(F.lit(1)).alias("n"), F.sum(mark("u", "v")).alias("s")


def mark(*columns: str) -> Column:
    """A small hash whose sum over a table tells whether the table changed."""
    return F.xxhash64(*columns).bitwiseAND(F.lit((1 << 40) - 1)).cast("decimal(20,0)")
