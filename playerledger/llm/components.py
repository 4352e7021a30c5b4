"""Connected components of a link table, wholly in Spark.

Large-star / small-star: every round points each node's larger neighbours, then
each node itself, to the smallest neighbour, until the links are stars.  Minima
are aggregated before the shuffle and joined back, so a node with a third of all
links never has them gathered in one task.

Before the first and after every round each task turns its own links into stars
by union-find, which shortens long chains where they stand; a task takes about
``LINKS_A_TASK`` links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playerledger.llm.common import stored, workers_ready

LINKS_A_TASK = 500_000


def union_find(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of the links (u, v): every node that is not the smallest of its component."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        # each end's root moves to the smaller of the two
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    leaf = root != np.arange(len(nodes))
    return nodes[leaf], nodes[root[leaf]]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if held:
        u, v = union_find(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def _shortened(links: DataFrame, tasks: int) -> DataFrame:
    return stored(links.coalesce(tasks).mapInArrow(_stars, "u long, v long"), "links")


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links (u, v) with u > v.  One star step, same shape out."""
    if large:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = links.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u")
        return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u")
    onward = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return onward.union(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node that has a link; ``component`` is the smallest node reachable.

    ``links``: two columns of longs, any order and direction; self links and
    nulls are ignored.  An empty table gives an empty table.
    """
    workers_ready(links.sparkSession)
    a, b = (F.col(f"`{c}`") for c in links.columns[:2])
    now = links.filter(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = _shortened(now, max(1, -(-now.count() // LINKS_A_TASK)))
    before, state = None, _state(now)
    while state != before and state[0]:
        now = _shortened(_star(_star(now, True), False), max(1, -(-state[0] // LINKS_A_TASK)))
        before, state = state, _state(now)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
