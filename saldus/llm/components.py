"""Connected components by contraction inside partitions and pointer jumping between them; nothing is gathered on the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldus.llm import scratch

SCHEMA = "u long, v long, changed boolean"


def roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node reachable) for the ends of the edges (u, v)."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    parent = np.arange(len(nodes))
    while True:
        low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
        if (low == high).all():
            return nodes, nodes[parent]
        np.minimum.at(parent, high, low)
        while True:
            above = parent[parent]
            if (above == parent).all():
                break
            parent = above


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's edges as stars around the least node of each of its own components."""
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy(zero_copy_only=False)) for b in batches if b.num_rows]
    if parts:
        u, v, changed = (np.concatenate(x) for x in zip(*parts, strict=True))
        node, root = roots(u, v)
        own = node != root
        node, root = node[own], root[own]
        same = np.lexsort((v, u))
        u, v = u[same], v[same]
        first = np.ones(len(u), bool)
        first[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
        u, v = u[first], v[first]
        now = bool(changed.any()) or len(u) != len(node) or not (np.array_equal(u, node) and np.array_equal(v, root))
        for lo in range(0, len(node), 1 << 16):
            part = slice(lo, lo + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(node[part]), pa.array(root[part]), pa.array(np.full(len(node[part]), now))], names=["u", "v", "changed"])


def stars(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (u, v: long) that isn't the smallest node reachable, its component.

    A round contracts each partition to stars around its least nodes, deals the stars by their outer node, contracts again, and lets each node
    skip to its centre's centre. The first contraction sends a node at most once from each partition, so a hub's edges never meet in one
    task; the skip is a join, whose skewed side Spark splits. Rounds end when nothing has moved. Null ends are dropped; repeated edges and
    loops change nothing.
    """
    now = edges.where("u <> v").select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v"))
    before = None
    while True:
        fresh = now.withColumn("changed", F.lit(False)).mapInArrow(_contracted, SCHEMA).withColumn("changed", F.lit(False))
        dealt = scratch.stored(fresh.repartition("u").mapInArrow(_contracted, SCHEMA), "cc")
        above = dealt.select(F.col("u").alias("w"), F.col("v").alias("x"))
        skipped = dealt.join(above, dealt["v"] == above["w"], "left").select("u", F.coalesce("x", "v").alias("v"), (F.col("changed") | F.col("x").isNotNull()).alias("changed"))
        after = scratch.stored(skipped, "cc")
        scratch.drop(dealt)
        if before is not None:
            scratch.drop(before)
        before, now = after, after.select("u", "v")
        if not after.agg(F.max("changed")).first()[0]:
            return after.select(F.col("u").alias("node"), F.col("v").alias("component"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (u, v: long); a node with loops alone is its own component's only member."""
    known = stars(edges)
    nodes = edges.where("u is not null and v is not null").select(F.explode(F.array(F.col("u").cast("long"), F.col("v").cast("long"))).alias("node")).distinct()
    return nodes.join(known, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
