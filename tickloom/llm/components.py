"""Connected components by local contraction and alternating large-star and small-star steps.

Nodes and links stay in tables.  Each split of a table is first replaced by the stars of its own components, in slabs of
at most ``SLAB`` links; the star steps then join what lies in different splits.  Each step sums before it shuffles, and is
written to the shared folder.  No step raises a node's smallest neighbour or adds links, so the steps end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import common

#: Links that a Python worker contracts at once: about 150 MB.
SLAB = 1_000_000


def _toward(edges: DataFrame) -> DataFrame:
    """Distinct links (u, v) with u > v."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links that is not the smallest of its component, with that smallest node."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    parent, a, b = np.arange(len(nodes)), at[: len(u)], at[len(u) :]
    while True:
        a, b = parent[a], parent[b]
        apart = a != b
        if not apart.any():
            break
        a, b = np.maximum(a, b)[apart], np.minimum(a, b)[apart]
        np.minimum.at(parent, a, b)
        while (parent[parent] != parent).any():
            parent = parent[parent]
    below = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[below], nodes[parent[below]]


def _contract(batches):
    held, size = [], 0

    def emit():
        u, v = stars(*(np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("u", "v")))
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= SLAB:
            yield emit()
            held, size = [], 0
    if size:
        yield emit()


def _settled(edges: DataFrame) -> DataFrame:
    """``edges``, written, with each split contracted."""
    whole = common.materialize(_toward(edges), "cc")
    out = common.materialize(whole.mapInArrow(_contract, "u bigint, v bigint"), "cc")
    common.discard(whole)
    return out


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node is on the left once at most, and then never on the right."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("left"), F.lit(0).alias("right"))
    ends = ends.unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("left"), F.lit(1).alias("right")))
    return ends.groupBy("x").agg(F.sum("left").alias("left"), F.max("right").alias("right")).where("left + right > 1 and left > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) to (u, v): each node that is not the smallest of its component, with that smallest node."""
    now = _settled(edges)
    while not _are_stars(now):
        after = _settled(_small_star(_toward(_large_star(now))))
        common.discard(now)
        now = after
    return now
