"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact confirmation.

1. Each document becomes the set of its word shingles and a MinHash signature of it. Documents with
   equal sets fall into one node by aggregation, however many they are.
2. Bands of the signature are hashed into buckets; nodes in one bucket are candidates.
3. A candidate pair's signatures are compared in batches. After each batch the posterior probability
   that the similarity reaches the threshold, under a uniform prior, is a binomial tail; the pair is
   dropped as soon as it falls below the chosen miss probability.
4. Survivors are confirmed on the full shingle sets.

No bucket emits all its pairs. In the first rounds every node is compared with a few hubs of its
bucket (the least nodes under some random orders), the confirmed links are contracted into
components, and only nodes in different components go on; a last round compares what is left in full,
within the task that has the bucket, and gives out the links alone, so no link between different
components is lost.

Defined results: a document without words, or null, has an empty set and links with nothing; one
with fewer words than a shingle has its whole sequence as one shingle; ids should be unique, rows
that share an id share a node when their sets are linked; rows with a null id are given back with a
null component unless an equal set has an id; repeated rows all come back; an empty table gives an
empty table; only named columns are read, so other names cannot clash.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.buckets import Rows, bucket_components, links_in_tasks
from barflow.llm.common import cleaned, growing, release, small_batches, stored
from barflow.llm.wordcodes import mixed, shingles, word_chunks

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Settings:
    """Similarity ``percent`` / 100 on shingles of ``words`` words. With 30 bands of 6 hashes a pair
    at 0.85 misses every band with probability 7e-7, one at 0.8 with 1e-4 (for 40 bands 5e-6)."""

    words: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 6
    batch: int = 30
    miss: float = 1e-7

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def _hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return seeds[:n] | np.uint64(1), seeds[n:]


def _set_arrays(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The distinct shingle codes of each row, in order."""
    for chunk in word_chunks(column):
        codes, bounds = shingles(chunk, words)
        for i, j in zip(bounds[:-1], bounds[1:], strict=True):
            yield np.unique(codes[i:j])


SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, signature binary"


def signatures(docs: DataFrame, settings: Settings, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Size, 128-bit digest and MinHash signature of each document's shingle set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, shifts = _hash_family(settings.hashes)
        for batch in batches:
            counts, firsts, seconds, signed = [], [], [], []
            pending: list[np.ndarray] = []

            def flush(pending=pending, signed=signed, firsts=firsts, seconds=seconds):
                filled = [s for s in pending if len(s)]
                if filled:
                    codes = np.concatenate(filled)
                    at = np.concatenate(([0], np.cumsum([len(s) for s in filled])[:-1]))
                    least = np.empty((len(filled), settings.hashes), dtype="<u4")
                    for j in range(settings.hashes):
                        hashed = ((codes * factors[j] + shifts[j]) >> np.uint64(32)).astype(np.uint32)
                        least[:, j] = np.minimum.reduceat(hashed, at)
                    a = np.add.reduceat(codes, at).view(np.int64)
                    b = np.bitwise_xor.reduceat(mixed(codes), at).view(np.int64)
                k = 0
                for s in pending:
                    if len(s):
                        firsts.append(a[k]), seconds.append(b[k]), signed.append(least[k].tobytes())
                        k += 1
                    else:
                        firsts.append(0), seconds.append(0), signed.append(b"")
                pending.clear()

            held = 0
            for codes in _set_arrays(batch.column(1), settings.words):
                counts.append(len(codes))
                pending.append(codes)
                held += len(codes)
                if held > 100_000:
                    flush()
                    held = 0
            flush()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(counts, pa.int64()), pa.array(firsts, pa.int64()),
                    pa.array(seconds, pa.int64()), pa.array(signed, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "signature"],
            )

    return docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text)).mapInArrow(sign, SIGNED)


def band_rows(nodes: DataFrame, settings: Settings) -> DataFrame:
    """(bucket, node, size) for each band of each node's signature."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            bucket = _band_keys(_matrix(batch.column(1), settings), settings)
            ids, sizes = (np.repeat(np.asarray(batch.column(i)), settings.bands) for i in (0, 2))
            columns = [pa.array(bucket.ravel().view(np.int64)), pa.array(ids), pa.array(sizes)]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "node", "size"])

    return nodes.select("node", "signature", "n_shingles").mapInArrow(split, "bucket long, node long, size long")


def _band_keys(signed: np.ndarray, settings: Settings) -> np.ndarray:
    """A 64-bit key for each signature and band."""
    keys = np.empty((len(signed), settings.bands), dtype=np.uint64)
    for b in range(settings.bands):
        code = np.full(len(signed), b + 1, dtype=np.uint64)
        for j in range(b * settings.rows, (b + 1) * settings.rows):
            code = mixed(code * np.uint64(0x9FB21C651E98DF25) + signed[:, j])
        keys[:, b] = code
    return keys


def _matrix(column: pa.Array, settings: Settings) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype="<u4").reshape(-1, settings.hashes)


def least_matches(settings: Settings) -> list[tuple[int, int]]:
    """(hashes compared, matches needed): below them the posterior of reaching the threshold is less
    than the miss probability. For a uniform prior it is the chance of at most m successes in n + 1."""
    t, wanted = settings.percent / 100, []
    for n in range(settings.batch, settings.hashes + 1, settings.batch):
        below, m = 0.0, 0
        while m <= n:
            below += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if below >= settings.miss:
                break
            m += 1
        wanted.append((n, m))
    return wanted


def _prune(pairs: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) whose signatures pass every batch."""
    steps = least_matches(settings)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x, y = _matrix(batch.column(2), settings), _matrix(batch.column(3), settings)
            live, matches, done = np.arange(len(batch)), np.zeros(len(batch), np.int64), 0
            for n, least in steps:
                matches[live] += (x[live, done:n] == y[live, done:n]).sum(axis=1)
                live, done = live[matches[live] >= least], n
            yield batch.select([0, 1]).take(pa.array(live))

    left = nodes.select(F.col("node").alias("a"), F.col("signature").alias("x"))
    right = nodes.select(F.col("node").alias("b"), F.col("signature").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def _confirm(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The pairs whose full shingle sets reach the similarity."""
    words, percent = settings.words, settings.percent

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = zip(_set_arrays(batch.column(2), words), _set_arrays(batch.column(3), words), strict=True)
            linked = []
            for x, y in sets:
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _with_signatures(rows: Rows, settings: Settings) -> Rows:
    signed = _matrix(pa.array(rows["signature"].tolist(), pa.binary()), settings)
    return rows | {"signed": signed, "bands": _band_keys(signed, settings), "sets": np.full(len(signed), None)}


def _group_links(rows: Rows, at: np.ndarray, settings: Settings, steps: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Links that join components of one group. A pair is looked at in the first band it shares only,
    its signatures are pruned batch by batch, and the survivors' full sets are compared unless links
    found before join them."""
    nodes, sizes, blocks, signed, keys = (rows[c][at] for c in ("node", "size", "block", "signed", "bands"))
    within = rows["low"][at[0]] == rows["high"][at[0]]
    component, found = rows["component"][at].copy(), []
    band = int(np.argmax(keys[0] == rows["bucket"][at[0]].view(np.uint64)))

    def set_of(i: int) -> np.ndarray:
        sets, row = rows["sets"], at[i]
        if sets[row] is None:
            sets[row] = next(_set_arrays(pa.array([rows["text"][row]], pa.string()), settings.words))
        return sets[row]

    for i in range(len(nodes) - 1):
        live = np.arange(i + 1, len(nodes))
        ok = component[live] != component[i]
        ok &= 100 * np.minimum(sizes[live], sizes[i]) >= settings.percent * np.maximum(sizes[live], sizes[i])
        if not within:
            ok &= blocks[live] != blocks[i]
        live = live[ok]
        live = live[~(keys[live, :band] == keys[i, :band]).any(axis=1)]
        matches, done = np.zeros(len(live), np.int64), 0
        for n, least in steps:
            matches += (signed[live, done:n] == signed[i, done:n]).sum(axis=1)
            passed = matches >= least
            live, matches, done = live[passed], matches[passed], n
        for j in live[np.argsort(-matches, kind="stable")].tolist():
            if component[i] == component[j]:
                continue
            x, y = set_of(i), set_of(j)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= settings.percent * (len(x) + len(y) - both):
                found.append((int(min(nodes[i], nodes[j])), int(max(nodes[i], nodes[j]))))
                component[component == component[j]] = component[i]
    return found


@cleaned
def near_duplicates(docs: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row; kept marks the least id of a component."""
    small_batches(docs)
    signed = stored(signatures(docs, settings, id_column, text), "signatures")
    by_set = signed.where("n_shingles > 0").groupBy("n_shingles", "set_a", "set_b")
    nodes = stored(
        by_set.agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature")).where("node IS NOT NULL"),
        "nodes",
    )
    rows = band_rows(nodes, settings)
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = stored(rows.join(shared, "bucket"), "buckets")
    involved = stored(members.select("node").distinct(), "candidates")
    wanted = docs.select(F.col(id_column).cast("bigint").alias("node"), F.col(text).alias("text"))
    texts = stored(wanted.join(growing(involved), "node"), "texts")
    sides = nodes.join(involved, "node", "left_semi").select("node", "signature")
    steps = least_matches(settings)
    alike = 100 * F.least("size", "other_size") >= settings.percent * F.greatest("size", "other_size")
    labels = bucket_components(
        members, lambda pairs: _confirm(_prune(pairs, sides, settings), texts, settings), alike,
        lambda left: links_in_tasks(
            left, sides.join(texts, "node"), lambda rows: _with_signatures(rows, settings),
            lambda rows, at: _group_links(rows, at, settings, steps),
        ),
    )
    release(members, involved, texts)
    same_set = ["n_shingles", "set_a", "set_b"]
    by_node = nodes.select(*same_set, "node").join(labels, "node", "left")
    by_node = by_node.select(*same_set, F.coalesce("component", "node").alias("component_id"))
    result = signed.drop("signature").join(by_node, same_set, "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
