"""From buckets of candidates to components, without all the pairs of a bucket.

In the first rounds the members of a bucket meet a few hubs only: the least members under some
random orders, the same in every bucket that has them. Confirmed links are contracted, and only
members in different components go on. The last round takes all pairs that are still apart, within the
task where their bucket is if the caller has a way to do that, so no link between components is lost.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import release, stored, tables
from barflow.llm.components import connected_components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKET_ROWS = 2048


def _open_buckets(members: DataFrame, *more) -> DataFrame:
    """Buckets whose members lie in two components or more."""
    span = [F.min("component").alias("c0"), F.max("component").alias("c1")]
    return members.groupBy("bucket").agg(*span, *more).where("c0 <> c1").drop("c0", "c1")


def _hub_pairs(members: DataFrame, alike: Column, hubs: int, turn: int) -> DataFrame:
    """Each member of a bucket with the hubs of the bucket that lie in another component."""
    ranks = [F.xxhash64("node", F.lit(turn * hubs + j)) for j in range(hubs)]
    least = [F.min_by(F.struct("node", "component", "size"), rank) for rank in ranks]
    chosen = _open_buckets(members, F.array_distinct(F.array(*least)).alias("hubs"))
    hub = chosen.select("bucket", F.explode("hubs").alias("hub")).select(
        "bucket", F.col("hub.node").alias("b"), F.col("hub.component").alias("other"), F.col("hub.size").alias("other_size")
    )
    # one side has the few hubs of a bucket, the other its members, which are split when they are many
    met = members.join(hub, "bucket").where((F.col("component") != F.col("other")) & alike)
    return met.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()


def _left_pairs(members: DataFrame, alike: Column) -> DataFrame:
    """All pairs of a bucket that are still in different components."""
    other = members.select(
        "bucket", F.col("node").alias("b"), F.col("component").alias("other"), F.col("size").alias("other_size")
    )
    apart = (F.col("node") < F.col("b")) & (F.col("component") != F.col("other"))
    return members.join(other, "bucket").where(apart & alike).select(F.col("node").alias("a"), "b").distinct()


Rows = dict[str, np.ndarray]


def links_in_tasks(members: DataFrame, details: DataFrame, prepare: Callable[[Rows], Rows],
                   link: Callable[[Rows, np.ndarray], list[tuple[int, int]]]) -> DataFrame:
    """Links (a, b) between different components within buckets, found where the bucket is.

    A task gets the members of some buckets with the columns of ``details`` (node, …); ``prepare`` adds
    arrays for all of them at once, ``link`` gets the places of one bucket's. A bucket of more than
    ``BUCKET_ROWS`` members is cut into blocks, and every two blocks meet in a group of their own, where
    ``block``, ``low`` and ``high`` tell which pairs are due.
    """
    counts = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BUCKET_ROWS).alias("blocks"))
    met = (
        members.join(counts, "bucket")
        .withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .drop("blocks", "other")
    )
    groups = max(1, met.count() // BUCKET_ROWS)
    dealt = F.pmod(F.xxhash64("bucket", "low", "high"), F.lit(groups))
    full = met.join(details, "node").withColumn("dealt", dealt)

    def find(frame: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        keys = ["bucket", "low", "high"]
        frame = frame.sort_values([*keys, "node"]).drop_duplicates([*keys, "node"])
        rows = prepare({c: frame[c].to_numpy() for c in frame.columns})
        changed = np.zeros(max(0, len(frame) - 1), dtype=bool)
        for key in keys:
            changed |= rows[key][1:] != rows[key][:-1]
        edges = [0, *(np.flatnonzero(changed) + 1).tolist(), len(frame)]
        for begin, end in zip(edges[:-1], edges[1:], strict=True):
            if end - begin > 1:
                found += link(rows, np.arange(begin, end))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return full.groupBy("dealt").applyInPandas(find, "a long, b long")


def bucket_components(members: DataFrame, confirm: Callable[[DataFrame], DataFrame], alike: Column | None = None,
                      rest: Callable[[DataFrame], DataFrame] | None = None, hubs: int = 3,
                      hub_rounds: int = 2) -> DataFrame:
    """(node, component) of all linked nodes. ``members``: (bucket, node, size); ``confirm`` keeps the pairs
    (a, b) that are links; ``alike``: a condition on size and other_size that every link meets; ``rest``
    gives the links between components within the buckets left, instead of confirming all their pairs."""
    alike = F.lit(True) if alike is None else alike
    labelled, labels, edges = members.withColumn("component", F.col("node")), None, []
    for turn in range(hub_rounds + 1):
        if turn < hub_rounds:
            found = confirm(_hub_pairs(labelled, alike, hubs, turn))
        else:
            found = rest(labelled) if rest else confirm(_left_pairs(labelled, alike))
        found = stored(found, "links")
        if labels is not None and found.isEmpty():
            release(found)
            continue
        # the links before are known by the components they made
        rays = [] if labels is None else [labels.where("node <> component").toDF("a", "b")]
        last_edges = edges
        with tables() as edges:
            labels = connected_components(reduce(DataFrame.unionByName, rays, found))
        release(found, *last_edges)
        if turn < hub_rounds:
            last = labelled
            labelled = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
            # buckets that lie in one component are done
            labelled = stored(labelled.join(_open_buckets(labelled), "bucket"), "labelled")
            release(last)
            if labelled.isEmpty():
                break
    release(labelled)
    return labels
