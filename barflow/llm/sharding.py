"""Byte-balanced shards by Karmarkar-Karp differencing of indivisible groups.

Rows with equal texts form a group that stays together. Groups are dealt by hash into a fixed number
of bundles, whose byte sums are the numbers to be partitioned: so the planning step is bounded
whatever the corpus, every bundle is a set of whole groups, and a group that is larger than all
others only makes its bundle large. The k-way differencing starts with one partial partition per
bundle and repeatedly combines the two with the largest spread, the largest subset of one with the
smallest of the other.

Places inside a shard come from counts per block of rows: a block is a bundle or, where a bundle has
many rows (a text copied very often), a hash slice of it, so no window holds a hot group.

Defined results: a null text has no bytes and counts 1; null texts form one group, empty texts
another; repeated rows are placed one by one; ties in size go by bundle number; an empty table gives
an empty table; further columns are dropped unless named in ``keep``.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.llm.common import unsigned_crc32

BUNDLES = 8192
BLOCKS = 4096


def differencing(sizes: list[tuple[int, int]], shards: int) -> dict[int, int]:
    """Shard of each key, for (key, size) pairs: k-way Karmarkar-Karp.

    A partial partition is a list of (sum, keys) by descending sum; subsets without keys count 0.
    """
    heap = []
    for order, (key, size) in enumerate(sorted(sizes, key=lambda x: (-x[1], x[0]))):
        parts = [(size, [key])] + [(0, [])] * (shards - 1)
        heap.append((-size, order, parts))
    heapq.heapify(heap)
    order = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        joined = []
        for (x, keys_x), (y, keys_y) in zip(a, reversed(b), strict=True):
            longer, shorter = (keys_x, keys_y) if len(keys_x) >= len(keys_y) else (keys_y, keys_x)
            joined.append((x + y, longer + shorter if shorter else longer))
        joined.sort(key=lambda part: -part[0])
        least = joined[-1][0]
        joined = [(total - least, keys) for total, keys in joined]
        order += 1
        heapq.heappush(heap, (-joined[0][0], order, joined))
    return {key: shard for _, _, parts in heap for shard, (_, keys) in enumerate(parts) for key in keys}


def with_bundles(docs: DataFrame, text: str, bundles: int) -> Column:
    return F.pmod(F.xxhash64(F.col(text), F.col(text).isNull()), F.lit(bundles)).cast("int")


def assign_shards(docs: DataFrame, shards: int = 8, text: str = "text", order: tuple[str, ...] = ("doc_id",),
                  keep: tuple[str, ...] = ("doc_id",), bundles: int = BUNDLES, blocks: int = BLOCKS) -> DataFrame:
    """``keep`` columns with bytes, crc32, shard and the place in it.

    The driver holds one line per bundle, at most ``bundles``.
    """
    spark = docs.sparkSession
    sized = docs.select(
        *[F.col(c) for c in keep],
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        unsigned_crc32(F.col(text)).alias("text_crc32"),
        with_bundles(docs, text, bundles).alias("bundle"),
    )
    sums = sized.groupBy("bundle").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    plan = differencing([(r["bundle"], r["size"]) for r in sums], shards)
    total = sum(r["n"] for r in sums)
    slices = {r["bundle"]: max(1, -(-r["n"] * blocks // max(total, 1))) for r in sums}
    rows = [(b, plan[b], slices[b]) for b in sorted(plan)]
    layout = F.broadcast(spark.createDataFrame(rows, "bundle int, shard int, slices long"))  # at most `bundles` rows
    slice_of = F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.col("slices"))
    placed = sized.join(layout, "bundle").withColumn("slice", slice_of)
    block = ["shard", "bundle", "slice"]
    counts = placed.groupBy(*block).agg(F.count(F.lit(1)).alias("n"))
    # one line per block, at most bundles + blocks of them in all shards
    before = Window.partitionBy("shard").orderBy("bundle", "slice").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*block, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy(*block).orderBy(*[F.col(c) for c in order], "text_crc32", "size")
    numbered = placed.withColumn("nth", F.row_number().over(inside) - 1)
    return numbered.join(F.broadcast(first), block).select(  # bounded as counts is
        *keep, "size", "text_crc32", "shard", (F.col("first") + F.col("nth")).cast("bigint").alias("slot")
    )


def write_shards(docs: DataFrame, path: str, shards: int = 8, text: str = "text", id_column: str = "doc_id") -> None:
    """The whole rows, in one folder per shard; rows of a shard may lie in any number of files."""
    plan = assign_shards(docs, shards, text, (id_column,), (id_column, text))
    plan.select(id_column, text, "shard", "slot").write.partitionBy("shard").parquet(path)
