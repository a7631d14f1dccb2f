"""Connected components of a graph given as a table of links."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import give_back
from .stages import stored

# Links that a task joins to stars at once.
CHUNK = 500_000


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links that is not the smallest in its reach, and that smallest one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        a, b = label[a], label[b]
        open_ = a != b
        if not open_.any():
            break
        a, b = a[open_], b[open_]
        # Roots hang on the smallest root they are linked to, then all nodes on their root.
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]
    hung = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[hung], nodes[label[hung]]


def _contracted(links: DataFrame) -> DataFrame:
    """The links of each task as stars: the same nodes in reach, by fewer links."""

    def contract(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= CHUNK:
                yield joined(held)
                held, rows = [], 0
        if rows:
            yield joined(held)
        give_back()

    def joined(held):
        a, b = (np.concatenate([x.column(i).to_numpy() for x in held]) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in stars(a, b)], ["a", "b"])

    return links.mapInArrow(contract, "a long, b long")


def components(links: DataFrame, name: str) -> DataFrame:
    """The smallest node that each node of ``links (a, b)`` reaches: ``(node, component)``.

    Tasks first join their own links to stars. While a node hangs on several, every round
    links each node's larger neighbours, then its smaller ones, to its smallest neighbour.
    Rounds grow with the logarithm of the longest path. A node's neighbours are never
    gathered; only the smallest is, by a partial aggregation. Rounds are stored, so lost
    executors cost no earlier round.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stored(_contracted(links.filter("a <> b")), f"{name}-links")
    for turn in range(64):
        # A task takes the small files of several, CHUNK links or so.
        tasks = -(-links.count() // CHUNK)
        links = stored(_contracted(links.coalesce(max(1, tasks))), f"{name}-stars-{turn}")
        ends = links.union(links.select(F.col("b").alias("a"), "b"))
        hung = ends.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high"))
        if hung.filter("low < high").isEmpty():
            break
        # Larger neighbours of each node go to its smallest neighbour.
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.union(lowest.filter("low < a").select("a", F.col("low").alias("b")))
        large = large.filter("a <> b")
        # Smaller neighbours, and the node itself, too.
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = small.union(lowest.select("a", F.col("low").alias("b"))).filter("a <> b").distinct()
        links = stored(small, f"{name}-{turn}")
    else:
        raise RuntimeError("components not settled after 64 rounds")
    return hung.select(F.col("a").alias("node"), F.col("low").alias("component"))
