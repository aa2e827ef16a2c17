"""Connected components of links, kept in tables, by forests in tasks and alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import column, dropped, kept, released

#: Links that a task takes to a forest at once.
FOREST = 1 << 18


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some links and the smallest node that each reaches by them."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    root = np.arange(len(nodes))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
    return nodes, nodes[root]


def forests(links: DataFrame, a: str, b: str, tasks: int) -> DataFrame:
    """node, label: what a task's links connect, each node with the smallest of its tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs, size = [], [], 0

        def told() -> pa.RecordBatch:
            return pa.record_batch([pa.array(x) for x in forest(np.concatenate(us), np.concatenate(vs))], names=["node", "label"])

        for batch in batches:
            us.append(column(batch, "u").to_numpy())
            vs.append(column(batch, "v").to_numpy())
            size += batch.num_rows
            if size > FOREST:
                yield told()
                us, vs, size = [], [], 0
        if size:
            yield told()

    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    return edges.coalesce(tasks).mapInArrow(run, "node long, label long")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, label: the smallest node that each linked node reaches. Nodes are longs.

    Tasks, as many as the links ask for, first take some links each to a forest. Links that
    fit one are done then, without a shuffle. Of more, each turn joins every node to the
    smallest one near it, large neighbours first, then small ones, so paths shorten by more
    than half. No node's links are ever gathered: minima are pre-aggregated and joined back,
    which splits where a node has very many. The result is a table of its own; those of the
    turns before it are dropped.
    """
    tasks = 1 + links.count() // FOREST
    trees = kept(forests(links, a, b, tasks), "groups")
    if tasks == 1:
        return trees
    edges, before = kept(trees.select(F.col("node").alias("u"), F.col("label").alias("v")).where("u <> v").distinct(), "links"), None
    dropped(trees)
    written = edges
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        edges = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        near = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, edges = written, kept(near.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        written = edges
        dropped(last)
        released(links.sparkSession)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node")).distinct()
    labels = kept(edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        roots.select("node", F.col("node").alias("label"))), "groups")
    dropped(written)
    return labels
