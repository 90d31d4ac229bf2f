"""Connected components of a large edge table by alternating star contraction."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import release, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Edges that a task contracts at a time.
PORTION_EDGES = 1 << 19


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges (u, v) that hang every node on the least node of its component; u > v."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while (label[x] != label[y]).any():
        least = np.minimum(label[x], label[y])
        np.minimum.at(label, label[x], least)
        np.minimum.at(label, label[y], least)
        while (label[label] != label).any():
            label = label[label]
    rays = label != np.arange(len(nodes))
    return nodes[rays], nodes[label[rays]]


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with u > v that connect the same nodes, each portion of a task's edges made stars."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def given() -> pa.RecordBatch:
            sides = [np.concatenate([batch.column(i).to_numpy() for batch in held]) for i in range(2)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(side) for side in stars(*sides)], names=["u", "v"])

        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= PORTION_EDGES:
                yield given()
                size = 0
        if held:
            yield given()

    return edges.mapInArrow(contract, "u long, v long")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the least node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung on the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other at most, and none that does has nodes hung on it."""
    sides = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("hung"), F.lit(0).alias("root")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("hung"), F.lit(1).alias("root")),
    )).alias("side")).select("side.*")
    return sides.groupBy("node").agg(F.sum("hung").alias("hung"), F.max("root").alias("root")).where("hung + root > 1").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its least node.

    Tasks contract what they read before it is shuffled, which spares rounds. Minima are partial aggregates and
    the joins have one row per node on one side, so a star with very many rays is split by adaptive
    execution. Rounds go on until all edges are stars.
    """
    now = stored(_contracted(edges.select("a", "b")).distinct(), "edges")
    while not _are_stars(now):
        last, now = now, stored(_small_star(_large_star(_contracted(now))), "edges")
        release(last)
    roots = now.select(F.col("v").alias("node")).distinct()
    rays = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return rays.unionByName(roots.select("node", F.col("node").alias("component")))
