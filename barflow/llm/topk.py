"""Exact nearest vectors by inner product: three-phase uniform threshold.

The components are cut into ``lists`` runs; a vector has one partial score for a query in each, and
its score is their sum. Rows lie in blocks of bounded size and queries in blocks of their own; a cell
is one block of either, and has the lists of its rows.

1. Every cell gathers, for each query and list, the k rows of largest partial score, with the scores
   of those rows. The k-th best score of a query among all that was gathered is a safe cutoff t: at
   least k rows reach it.
2. The cutoff goes with the query to all cells. A row that reaches t has a partial score of t / lists
   or more in at least one list, so each cell collects the entries at or above that share. What a row
   can reach at most, with the share in place of the lists it was not seen in, must be t or more.
3. The scores of the rows still in question are resolved exactly from all their components; those
   of t or more, at most k a query and stripe of blocks, are ranked.

Every query meets every row: blocks of rows are dealt into stripes of bounded bytes, the blocks of queries
are sent to each stripe, and both are joined by stripe. So no task holds more than one stripe, no
row is sent twice, and what is shuffled besides is k entries a query and stripe. Sums are exact: in doubles
while no partial sum can reach 2**53, else in longs, else in Python integers.

Defined results: vectors that are null or hold a null or non-finite component take no part, neither
as queries; shorter vectors count as ending in zeros, so an empty one scores 0; ties go to the
smaller id, null ids last; rows that repeat an id are candidates, and queries, of their own, and a
query leaves out its own row only; scores beyond a long are held to its ends; with fewer than k
candidates all are returned, with none (or an empty table) no row is; further columns are dropped.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.llm import vectors
from barflow.llm.common import growing, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROW_BLOCK_BYTES = 1 << 20
QUERY_BLOCK_BYTES = 1 << 18
STRIPE_BYTES = 64 << 20
BLOCK_ROWS = 2048
NO_ID = np.iinfo(np.int64).max  # stands for a null id, which sorts last
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max

PACKED = "block long, n long, width long, uids binary, ids binary, cutoffs binary, known binary, chosen binary, numbers binary"


def packer(block_bytes: int):
    """Rows (uid, vec_id, cutoff, chosen, components) to blocks of at most ``block_bytes`` of components."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            uid, vec_id, cutoff, chosen, components = batch.columns
            numbers = vectors.matrix(components)
            uids = uid.to_numpy(zero_copy_only=False)
            ids = vec_id.fill_null(NO_ID).to_numpy(zero_copy_only=False)
            known = cutoff.is_valid().to_numpy(zero_copy_only=False)
            cutoffs = cutoff.fill_null(0).to_numpy(zero_copy_only=False)
            flags = chosen.to_numpy(zero_copy_only=False).astype(bool)
            step = min(BLOCK_ROWS, max(1, block_bytes // (8 * max(1, numbers.shape[1]))))
            rows = []
            for at in range(0, batch.num_rows, step):
                part = slice(at, at + step)
                rows.append((
                    int(uids[part].min()), len(uids[part]), numbers.shape[1], uids[part].tobytes(), ids[part].tobytes(),
                    cutoffs[part].tobytes(), known[part].tobytes(), flags[part].tobytes(), np.ascontiguousarray(numbers[part]).tobytes(),
                ))
            kinds = [pa.int64()] * 3 + [pa.binary()] * 6
            names = ["block", "n", "width", "uids", "ids", "cutoffs", "known", "chosen", "numbers"]
            arrays = [pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return pack


ROWS = "uid long, vec_id long, components array<bigint>"


def chosen_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of blocks that are queries, unpacked again."""
    for batch in batches:
        for row in batch.to_pylist():
            at = np.flatnonzero(np.frombuffer(row["chosen"], dtype=bool))
            if not len(at):
                continue
            uids, ids = (np.frombuffer(row[name], dtype=np.int64)[at] for name in ("uids", "ids"))
            numbers = np.frombuffer(row["numbers"], dtype=np.int64).reshape(row["n"], row["width"])[at]
            lists = pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * row["width"], pa.array(numbers.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(uids), pa.array(ids, mask=ids == NO_ID), lists], names=["uid", "vec_id", "components"])


class Side:
    """One block as arrays."""

    def __init__(self, row: dict, prefix: str):
        n, width = row[f"{prefix}_n"], row[f"{prefix}_width"]
        self.block = row[f"{prefix}_block"]
        self.uids = np.frombuffer(row[f"{prefix}_uids"], dtype=np.int64)
        self.ids = np.frombuffer(row[f"{prefix}_ids"], dtype=np.int64)
        self.cutoffs = np.frombuffer(row[f"{prefix}_cutoffs"], dtype=np.int64)
        self.known = np.frombuffer(row[f"{prefix}_known"], dtype=bool)
        self.numbers = np.frombuffer(row[f"{prefix}_numbers"], dtype=np.int64).reshape(n, width)

    def widened(self, width: int) -> np.ndarray:
        return np.pad(self.numbers, ((0, 0), (0, width - self.numbers.shape[1])))


def exact_pair(q: np.ndarray, r: np.ndarray, lists: int) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices in the narrowest type that keeps all sums, also times ``lists``, exact."""
    largest = [max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0)))) for m in (q, r)]
    bound = largest[0] * largest[1] * max(1, q.shape[1]) * max(1, lists)
    kind = np.float64 if bound < 2**53 else np.int64 if bound < 2**62 else object
    return q.astype(kind), r.astype(kind)


def partial_scores(q: np.ndarray, r: np.ndarray, lists: int) -> list[np.ndarray]:
    """One matrix of queries by rows for each run of components."""
    cuts = np.linspace(0, q.shape[1], lists + 1).astype(int)
    return [q[:, a:b] @ r[:, a:b].T if b > a else np.zeros((len(q), len(r)), q.dtype) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def as_longs(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        return np.array([min(max(int(x), LEAST), MOST) for x in scores.ravel()], dtype=np.int64).reshape(scores.shape)
    return scores.astype(np.int64)


def largest(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest of every row, in no order."""
    if scores.shape[1] <= k:
        return np.tile(np.arange(scores.shape[1]), (len(scores), 1))
    if scores.dtype == object:
        return np.argsort(-scores, axis=1)[:, :k]
    return np.argpartition(scores, scores.shape[1] - k, axis=1)[:, -k:]


def gather(q: Side, r: Side, k: int, lists: int) -> tuple[np.ndarray, np.ndarray]:
    """Phase 1 in a cell: (query, score) of the rows that are among the k best of some list."""
    width = max(q.numbers.shape[1], r.numbers.shape[1])
    exact_q, exact_r = exact_pair(q.widened(width), r.widened(width), lists)
    parts = partial_scores(exact_q, exact_r, lists)
    own = q.uids[:, None] == r.uids[None, :]
    total = sum(parts)
    seen = np.zeros(own.shape, dtype=bool)
    for part in parts:
        if own.any():
            part = np.where(own, part.min() - 1, part)
        np.put_along_axis(seen, largest(part, k), True, axis=1)
    at, column = np.nonzero(seen & ~own)
    return at, as_longs(total[at, column])


def resolve(q: Side, r: Side, lists: int, pairs: int = 1 << 14) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phases 2 and 3 in a cell: (query, row, score) of all rows whose score reaches the query's cutoff."""
    width = max(q.numbers.shape[1], r.numbers.shape[1])
    exact_q, exact_r = exact_pair(q.widened(width), r.widened(width), lists)
    parts = partial_scores(exact_q, exact_r, lists)
    # without a cutoff all rows are in question; shares are compared times ``lists``, in whole numbers
    safe = q.cutoffs.astype(object) if exact_q.dtype == object or np.abs(q.cutoffs).max(initial=0) >= 2**52 else q.cutoffs.astype(exact_q.dtype)
    reached = [part * lists >= safe[:, None] for part in parts]
    most = sum(np.where(hit, part * lists, safe[:, None]) for part, hit in zip(parts, reached, strict=True))
    open_ = np.logical_or.reduce(reached) & (most >= safe[:, None] * lists)
    open_ = (open_ | ~q.known[:, None]) & (q.uids[:, None] != r.uids[None, :])
    at, column = np.nonzero(open_)
    scores = [
        as_longs((exact_q[at[i : i + pairs]] * exact_r[column[i : i + pairs]]).sum(axis=1)) for i in range(0, len(at), pairs)
    ]
    score = np.concatenate(scores) if scores else np.zeros(0, np.int64)
    keep = (score >= q.cutoffs[at]) | ~q.known[at]
    return at[keep], column[keep], score[keep]


def best_of(at: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores of every query; ties by id."""
    order = np.lexsort((ids, -score.astype(object) if len(score) and score.min() == LEAST else -score, at))
    sorted_at = at[order]
    rank = np.arange(len(order)) - np.searchsorted(sorted_at, sorted_at)
    return order[rank < k]


FOUND = "query_uid long, query_id long, vec_id long, score long"


def scanner(k: int, lists: int, last: bool):
    """Phase 1, or phases 2 and 3 if ``last``; entries of one query block and stripe are merged before they leave."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side, stripe, held = None, None, None

        def flushed() -> Iterator[pa.RecordBatch]:
            if held is not None and len(held[0]):
                at, score, ids = held
                columns = [pa.array(side.uids[at]), pa.array(side.ids[at], mask=side.ids[at] == NO_ID), pa.array(ids, mask=ids == NO_ID), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=["query_uid", "query_id", "vec_id", "score"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                if side is None or (row["q_block"], row["stripe"]) != (side.block, stripe):
                    yield from flushed()
                    side, stripe, held = Side(row, "q"), row["stripe"], None
                block = Side(row, "r")
                if last:
                    at, column, score = resolve(side, block, lists)
                    found = (at, score, block.ids[column])
                else:
                    at, score = gather(side, block, k, lists)
                    found = (at, score, np.zeros(len(at), np.int64))
                if held is not None:
                    found = tuple(np.concatenate(x) for x in zip(held, found, strict=True))
                kept = best_of(*found, k)
                held = tuple(x[kept] for x in found)
        yield from flushed()

    return scan


def cells(queries: DataFrame, blocks: DataFrame, stripes: int) -> DataFrame:
    """Every block of queries with every block of rows, dealt by the stripes of the rows."""
    q = queries.select(*[F.col(c).alias(f"q_{c}") for c in queries.columns])
    q = q.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    r = blocks.select(*[F.col(c).alias(f"r_{c}") for c in blocks.columns], F.pmod(F.xxhash64("block"), F.lit(stripes)).cast("int").alias("stripe"))
    return q.join(growing(r), "stripe")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """Rank within the query; only k rows of a query and task are shuffled."""
    order = Window.partitionBy("query_uid").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(df: DataFrame, is_query: Column, k: int = 10, lists: int = 2, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k rows with the largest inner product, for every row that is a query.

    ``is_query`` is a condition on ``df``; a null is no. Writes the packed rows and the entries of
    each phase below the shared folder.
    """
    none = F.lit(None).cast("bigint").alias("cutoff")
    shape = ["uid", "vec_id", "cutoff", "chosen", "components"]
    taken = df.where(vectors.is_usable(vector)).select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_column).cast("bigint").alias("vec_id"), none,
        F.coalesce(is_query, F.lit(False)).alias("chosen"), vectors.integer_components(vector).alias("components"),
    )
    blocks = stored(taken.mapInArrow(packer(ROW_BLOCK_BYTES), PACKED), "vector-blocks")
    asked = blocks.mapInArrow(chosen_rows, ROWS).withColumn("chosen", F.lit(True))
    totals = blocks.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("numbers")).alias("size")).first()
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stripes = max(1, min(totals["n"], max(2 * tasks, -(-(totals["size"] or 0) // STRIPE_BYTES))))

    def pass_over(queries: DataFrame, last: bool) -> DataFrame:
        packed = queries.select(*shape).mapInArrow(packer(QUERY_BLOCK_BYTES), PACKED)
        return stored(cells(packed, blocks, stripes).mapInArrow(scanner(k, lists, last), FOUND), "top-scores")

    gathered = pass_over(asked.withColumn("cutoff", none), False)
    kth = ranked(gathered, k).groupBy("query_uid").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("score"))
    cutoffs = kth.select(F.col("query_uid").alias("uid"), F.when(F.col("n") == k, F.col("score")).alias("cutoff"))
    resolved = pass_over(asked.join(growing(cutoffs), "uid", "left"), True)
    return ranked(resolved, k).select("query_id", "rank", "vec_id", "score")
