"""Repeated substrings by threshold-bounded interval expansion on a Burrows-Wheeler transform.

Every byte covered by a string of ``length`` bytes that also starts anywhere else is removed.

Where a global transform would need all texts in one place, equal strings are first brought together:
each window of ``length`` bytes picks the k-gram of least hash in it, leftmost among equals, so equal windows
pick equal k-grams at equal places. Consecutive windows that pick one k-gram make a fragment, also where it
moves on with them, as in periodic passages: those are one fragment, whatever their length. Fragments whose
k-gram occurs once in the corpus cannot repeat and are never cut out; equal fragments are counted by
digest; of the different fragments of one k-gram, each is cut out once and goes to one block.

In a block the transform of the joined fragments is expanded breadth first: from the intervals of
all strings of l bytes, one step to the left gives those of l + 1 bytes, and an interval whose right
end has no value yet fixes the common prefix there as l. Values come in increasing order, so after
``length`` rounds the expansion stops, and neighbours without a value share at least ``length`` bytes.

A k-gram whose fragments exceed ``GROUP_BYTES`` (a passage with very many different surroundings)
is not put in one block: its windows are counted by 128-bit digest over all tasks. So are those of a single
fragment that large (megabytes of padding).

Texts with equal copies are looked at once; a copied text of ``length`` bytes or more goes as a whole.

The removed byte ranges come with the counts that are made from them, in the column ``spans``: ascending, apart, each
from a 0-based ``start``.

Defined results: null and empty texts have no bytes, nothing removed and the hash of nothing; a text
shorter than ``length`` keeps all; repeated rows count as copies; null ids pass; rows come back one
for one; an empty table gives an empty table; only named columns are read.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import cleaned, growing, release, small_batches, stored, text_or_empty, unsigned_crc32
from barflow.llm.wordcodes import column_bytes, mixed, powers

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 400
#: Bytes of the k-gram that a window picks; most of a window, so that few texts share one by chance.
GRAM_SHARE = 3
BLOCK_BYTES = 1 << 20
MAX_PARTITIONS = 10_000
GROUP_BYTES = 4 << 20
#: Rows that a task makes before it hands them on.
HANDED_ROWS = 100_000
SEPARATOR = 0xFF  # in no UTF-8 text
PLACE_BITS = np.uint64(32)


def picks(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, code of the k-gram, places of it) of every run of windows that pick one k-gram."""
    n, k = len(data), max(1, length // GRAM_SHARE)
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    codes = mixed((sums[k:] - sums[:-k]) * down[: n - k + 1])
    # high bits of the code, then the place: the least is the leftmost of the least codes, in every text alike
    least = ((codes >> PLACE_BITS) << PLACE_BITS) | np.arange(len(codes), dtype=np.uint64)
    window, span = length - k + 1, 1
    while 2 * span <= window:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = window - span
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    at = (least & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    moved = np.append(True, at[1:] != at[:-1])
    code = codes[at]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    return first, np.append(first[1:], len(at)) - 1, code[first], np.add.reduceat(moved.astype(np.int64), first)


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    raw, bounds = column_bytes(column)
    for i, j in zip(bounds[:-1], bounds[1:], strict=True):
        yield raw[i:j]


def _grams(texts: DataFrame, length: int) -> DataFrame:
    """(gram, key_a, n): at how many places a text picks a k-gram."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, codes, counts = [], [], []
            for key, data in zip(np.asarray(batch.column(0)), _texts(batch.column(1)), strict=True):
                _, _, picked, places = picks(data, length)
                code, which = np.unique(picked, return_inverse=True)
                keys.append(np.full(len(code), key)), codes.append(code)
                counts.append(np.bincount(which, places, len(code)).astype(np.int64))
            if keys:
                columns = [np.concatenate(codes).view(np.int64), np.concatenate(keys), np.concatenate(counts)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["gram", "key_a", "n"])

    return texts.select("key_a", "text").mapInArrow(pick, "gram long, key_a long, n long")


FRAGMENTS = "key_a long, key_b long, gram long, digest_a long, digest_b long, first long, last long, places long"


def _digest(data: bytes) -> tuple[int, int]:
    import xxhash

    whole = xxhash.xxh3_128_digest(data)
    return int.from_bytes(whole[:8], "little", signed=True), int.from_bytes(whole[8:], "little", signed=True)


def _fragments(texts: DataFrame, length: int) -> DataFrame:
    """Where the fragments of the texts' wanted k-grams (column ``grams``) are, with their digests."""
    names = [part.split()[0] for part in FRAGMENTS.split(", ")]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for (a, b), data, grams in zip(keys, _texts(batch.column(2)), batch.column(3), strict=True):
                first, last, codes, places = picks(data, length)
                codes = codes.view(np.int64)
                wanted = np.flatnonzero(np.isin(codes, grams.values.to_numpy(zero_copy_only=False)))
                found = (column[wanted].tolist() for column in (codes, first, last, places))
                for code, i, j, n in zip(*found, strict=True):
                    rows.append((a, b, code, *_digest(data[i : j + length].tobytes()), i, j, n))
            columns = list(zip(*rows, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return texts.select("key_a", "key_b", "text", "grams").mapInArrow(find, FRAGMENTS)


PIECES = "block long, gram long, digest_a long, digest_b long, data binary"


def _cut_out(texts: DataFrame, length: int) -> DataFrame:
    """The bytes of the fragments listed with each text (column ``pieces``)."""
    names = [part.split()[0] for part in PIECES.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            for data, pieces in zip(_texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                for piece in pieces:
                    for column, name in zip(columns[:-1], names[:-1], strict=True):
                        column.append(piece[name])
                    columns[-1].append(data[piece["first"] : piece["last"] + length].tobytes())
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return texts.select("text", "pieces").mapInArrow(cut, PIECES)


def _sorted_places(key: np.ndarray, bits: int) -> np.ndarray:
    """Places of the keys, which have ``bits`` bits, in ascending order: sorting keys that carry their
    place is several times faster than sorting places by key."""
    width = len(key).bit_length()
    if bits + width > 64:
        return np.argsort(key)
    carried = np.sort((key << np.uint64(width)) | np.arange(len(key), dtype=np.uint64))
    return (carried & np.uint64((1 << width) - 1)).astype(np.int64)


def suffix_order(data: np.ndarray, length: int) -> np.ndarray:
    """Starts of the suffixes in the order of their first ``length`` bytes or more, by prefix doubling."""
    n = len(data)
    span = 5
    padded = np.concatenate([data, np.full(span, SEPARATOR, np.uint8)]).astype(np.uint64)
    key, bits = np.zeros(n, dtype=np.uint64), 8 * span
    for j in range(span):
        key |= padded[j : j + n] << np.uint64(8 * (span - 1 - j))
    while True:
        order = _sorted_places(key, bits)
        fresh = np.ones(n, dtype=np.uint64)
        fresh[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, dtype=np.uint64)
        rank[order] = np.cumsum(fresh)
        if span >= length or int(rank[order[-1]]) == n:
            return order
        follow = np.zeros(n, dtype=np.uint64)
        follow[: max(0, n - span)] = rank[span:]
        bits = 2 * (n + 1).bit_length()
        key = (rank << np.uint64(bits // 2)) | follow
        span *= 2


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the intervals [low, high), and the interval of each."""
    size = high - low
    which = np.repeat(np.arange(len(low)), size)
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - low, size), which


def shared_prefix(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """By place in the order: whether the suffix shares ``length`` bytes with the one before it, for
    suffixes whose first ``length`` bytes hold no separator."""
    n = len(data)
    before = data[order - 1]  # the transform; the first suffix is preceded by the last byte, a separator
    step = np.empty(n, dtype=np.int64)  # from a suffix to the one a byte longer
    step[np.argsort(before, kind="stable")] = np.arange(n)
    valued = np.zeros(n + 1, dtype=bool)
    valued[0] = valued[n] = True
    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for _ in range(length):
        if not len(low):
            break
        places, which = _spread(low, high)
        plain = before[places] != SEPARATOR
        places, which = places[plain], which[plain]
        # within an interval, equal bytes lead to consecutive places
        to = step[places]
        group = which * 256 + before[places]
        by = _sorted_places(to.astype(np.uint64), n.bit_length())
        to, group = to[by], group[by]
        first = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (to[1:] != to[:-1] + 1))) if len(to) else to
        low = to[first]
        high = np.append(to[first[1:] - 1], to[-1:]) + 1 if len(to) else to
        new = ~valued[high]
        low, high = low[new], high[new]
        valued[high] = True
    return ~valued[:n]


def repeated_starts(fragments: list[bytes], length: int) -> list[np.ndarray]:
    """For each fragment, by window, whether the window starts elsewhere in the fragments too."""
    joined = np.frombuffer(b"".join(f + bytes([SEPARATOR]) for f in fragments), dtype=np.uint8)
    sizes = np.array([len(f) for f in fragments], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    valid = np.zeros(len(joined), dtype=bool)
    valid[_spread(starts, starts + sizes - length + 1)[0]] = True
    order = suffix_order(joined, length)
    real = valid[order]
    same = shared_prefix(joined, order, length)
    same[1:] &= real[1:] & real[:-1]
    same[0] = False
    found = np.zeros(len(joined), dtype=bool)
    found[order[same]] = True
    found[order[np.flatnonzero(same) - 1]] = True
    return [found[s : s + size - length + 1] for s, size in zip(starts, sizes, strict=True)]


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of each run of true flags."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True))


RUNS = "gram long, digest_a long, digest_b long, runs array<struct<first: long, last: long>>"


def _block_runs(frame: pd.DataFrame, length: int, block_bytes: int) -> pd.DataFrame:
    """Runs of repeated windows of the fragments of one block, some k-grams at a time."""
    frame = frame.sort_values(["gram", "digest_a", "digest_b"]).reset_index(drop=True)
    found: list[list[dict]] = []
    held: list[bytes] = []
    grams, data = frame["gram"].to_numpy(), frame["data"].tolist()
    size = 0
    for i, piece in enumerate(data):
        held.append(piece)
        size += len(piece)
        last_of_gram = i + 1 == len(data) or grams[i + 1] != grams[i]
        if last_of_gram and (size >= block_bytes or i + 1 == len(data)):
            for flags in repeated_starts(held, length):
                found.append([dict(first=a, last=b) for a, b in runs(flags)])
            held, size = [], 0
    return frame[["gram", "digest_a", "digest_b"]].assign(runs=found)


SPANS = "array<struct<start: bigint, length: bigint>>"
DONE = f"key_a long, key_b long, spans {SPANS}, kept_sha256 string"


def _remove(texts: DataFrame, length: int) -> DataFrame:
    """What is left of each text after its repeated windows (column ``windows``) are removed."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for (a, b), data, windows in zip(keys, _texts(batch.column(2)), batch.column(3).to_pylist(), strict=True):
                change = np.zeros(len(data) + 1, dtype=np.int64)
                for window in windows:
                    change[window["first"]] += 1
                    change[window["last"] + length] -= 1
                gone = np.cumsum(change[:-1]) > 0
                spans = [dict(start=i, length=j - i + 1) for i, j in runs(gone)]
                rows.append((a, b, spans, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
            span = pa.struct([("start", pa.int64()), ("length", pa.int64())])
            kinds = [pa.int64(), pa.int64(), pa.list_(span), pa.string()]
            names = ["key_a", "key_b", "spans", "kept_sha256"]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return texts.select("key_a", "key_b", "text", "windows").mapInArrow(cut, DONE)


def _hot_windows(texts: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """The stored windows of k-grams too large for a block (column ``runs`` has a text's fragments), and those of
    them, (key_a, key_b, window), whose digest occurs twice."""
    names = ["digest_a", "digest_b", "key_a", "key_b", "at"]

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []

            def given() -> pa.RecordBatch:
                columns = list(zip(*rows, strict=True)) or [()] * 5
                rows.clear()
                return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for (a, b), data, runs_ in zip(keys, _texts(batch.column(2)), batch.column(3).to_pylist(), strict=True):
                whole = data.tobytes()
                for run in runs_:
                    for i in range(run["first"], run["last"] + 1):
                        rows.append((*_digest(whole[i : i + length]), a, b, i))
                        if len(rows) >= HANDED_ROWS:
                            yield given()
            yield given()

    shape = "digest_a long, digest_b long, key_a long, key_b long, at long"
    windows = texts.select("key_a", "key_b", "text", "runs").mapInArrow(explode, shape)
    windows = stored(windows, "windows")
    twice = windows.groupBy("digest_a", "digest_b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return windows, windows.join(twice, ["digest_a", "digest_b"]).select(
        "key_a", "key_b", F.struct(F.col("at").alias("first"), F.col("at").alias("last")).alias("window")
    )


@cleaned
def remove_repeats(docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text: str = "text",
                   block_bytes: int = BLOCK_BYTES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) for every row."""
    body = text_or_empty(text)
    n_bytes = F.octet_length("text").cast("bigint")
    read = small_batches(docs).select(F.col(id_column).alias("doc_id"), body.alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("key_a"),
        (F.shiftleft(n_bytes, 32).bitwiseOR(unsigned_crc32(F.col("text")))).alias("key_b"),
    )
    keys = ["key_a", "key_b"]
    facts = stored(
        read.select("doc_id", *keys, n_bytes.alias("n_bytes"), F.sha2("text", 256).alias("whole_sha256")), "facts"
    )
    copies = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("doc_id"))
    grams = stored(_grams(read, length), "grams")
    often = grams.groupBy("gram").agg(
        F.min("key_a").alias("k0"), F.max("key_a").alias("k1"), F.max("n").alias("n")
    ).where("k0 <> k1 OR n > 1").select("gram")
    wanted = grams.join(growing(often), "gram").groupBy("key_a").agg(F.collect_set("gram").alias("grams"))  # of one text
    # one row of each text that has wanted k-grams
    chosen = copies.select(*keys, "doc_id").join(wanted, "key_a")
    same_id = read["doc_id"].eqNullSafe(chosen["doc_id"])
    texts = read.join(growing(chosen), (read["key_a"] == chosen["key_a"]) & (read["key_b"] == chosen["key_b"]) & same_id)
    texts = stored(texts.select(read["key_a"], read["key_b"], read["text"], chosen["grams"]), "texts")
    release(grams)
    places = stored(_fragments(texts, length), "fragments")
    kind = ["gram", "digest_a", "digest_b"]
    different = stored(
        places.groupBy(*kind).agg(
            F.count(F.lit(1)).alias("n"), F.max("places").alias("places"), F.min(F.struct(*keys, "first", "last")).alias("place")
        ), "different",
    )
    size = F.col("place.last") - F.col("place.first") + length
    groups = stored(
        different.groupBy("gram").agg(F.count(F.lit(1)).alias("m"), F.max("places").alias("places"), F.sum(size).alias("size")),
        "groups",
    )
    alike = groups.where("m > 1 OR places > 1")
    total = alike.where(f"size <= {group_bytes}").agg(F.sum("size")).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    small = alike.where(f"size <= {group_bytes}").select("gram")
    dealt = different.join(growing(small), "gram").select(
        "place.*", F.struct(F.pmod(F.xxhash64("gram"), F.lit(blocks)).alias("block"), *kind, "place.first", "place.last").alias("piece")
    )
    listed = dealt.groupBy(*keys).agg(F.collect_list("piece").alias("pieces"))  # of one text
    pieces = _cut_out(texts.join(growing(listed), keys), length)
    # a number of partitions of its own: blocks are costly for their size, so they are not put together by it
    spread = pieces.repartition(min(blocks, MAX_PARTITIONS), "block")
    expanded = spread.groupBy("block").applyInPandas(lambda frame: _block_runs(frame, length, block_bytes), RUNS)
    in_blocks = stored(expanded.where(F.size("runs") > 0), "runs")
    several = different.where("n > 1").select(*kind)
    by_run = places.join(growing(in_blocks), kind).select(*keys, "first", F.explode("runs").alias("run")).select(
        *keys, F.struct((F.col("first") + F.col("run.first")).alias("first"), (F.col("first") + F.col("run.last")).alias("last")).alias("window")
    )
    by_count = places.join(growing(several), kind, "left_semi").select(*keys, F.struct("first", "last").alias("window"))
    hot = alike.where(f"size > {group_bytes}").select("gram")
    hot_runs = places.join(hot, "gram").groupBy(*keys).agg(F.collect_list(F.struct("first", "last")).alias("runs"))  # of one text
    exploded, by_window = _hot_windows(texts.join(growing(hot_runs), keys), length)
    windows = by_run.unionByName(by_count).unionByName(by_window)
    lists = windows.groupBy(*keys).agg(F.collect_list("window").alias("windows"))  # of one text
    done = stored(_remove(texts.drop("grams").join(growing(lists), keys), length), "removed")
    release(texts, places, different, groups, in_blocks, exploded)
    done = done.dropDuplicates(keys)  # rows that repeat id and text
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    copied = copies.where("copies > 1").select(*keys, "copies")
    facts_with = facts.join(growing(copied), keys, "left").join(growing(done), keys, "left")
    nothing = hashlib.sha256(b"").hexdigest()
    all_of_it = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").alias("length"))).cast(SPANS)
    left = facts_with.select(
        "doc_id", "n_bytes",
        F.when(whole, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
        F.when(whole, all_of_it).otherwise(F.coalesce("spans", F.array().cast(SPANS))).alias("spans"),
    )
    return left.select(
        "doc_id", "n_bytes",
        F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, span: n + span["length"]).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        "kept_sha256", "spans",
    )
