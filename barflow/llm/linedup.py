"""Line dedup by a segment-partition edit join.

Lines within ``threshold`` edits (of code points) form a class, links being followed; of every class
the first line in (document, place) order stays and the others are taken out of their texts.

A line of length l is cut into threshold + 1 segments. If two lines are within the threshold, one
segment of the shorter is found in the longer, and only at the few starts that the multi-match-aware
bounds leave, which depend on both lengths. So a line enters a bucket (length, segment, substring hash)
for each of those starts and each length from l - threshold to l: 12 buckets for two edits. Lines
that share a bucket are candidates and are verified by a bit-parallel edit distance on the band of
2 * threshold + 1 diagonals. Buckets do not emit all their pairs (see ``buckets``).

Candidates are found for the 64-bit hashes of distinct lines; texts are moved only to verify.

Defined results: lines are compared without white space at their ends; those shorter than
``min_chars`` form a class only with their equals, if ``exact_short`` is set, else they are never touched;
empty lines are never touched; a null text stays null; a text whose lines all go becomes empty;
rows that share id and text are one document and stay alike; a null id comes first; all columns pass
through, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from os.path import commonprefix

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.buckets import Rows, bucket_components, links_in_tasks
from barflow.llm.common import SPACES, cleaned, free_name, growing, release, small_batches, stored, unsigned_crc32
from barflow.llm.wordcodes import mixed, powers

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Settings:
    threshold: int = 2
    min_chars: int = 20
    exact_short: bool = False


def within(a: str, b: str, k: int) -> bool:
    """Whether the edit distance is at most k.

    Vertical differences of the band's cells are kept as bits, bottom diagonal highest; the band
    moves down one row with each character of ``b``.
    """
    if abs(len(a) - len(b)) > k:
        return False
    head = len(commonprefix((a, b)))
    a, b = a[head:], b[head:]
    tail = len(commonprefix((a[::-1], b[::-1])))
    return _banded(a[: len(a) - tail], b[: len(b) - tail], k)


def _banded(a: str, b: str, k: int) -> bool:
    n, m = len(a), len(b)
    if n <= k or m <= k:
        return _table(a, b) <= k
    width = 2 * k + 2
    full, bottom = (1 << width) - 1, 1 << (width - 1)
    plus, minus, distance = (full << (k + 1)) & full, 0, k
    last_row = bottom >> 1
    for j, char in enumerate(b):
        low = j + k + 1 - width
        match = 0
        for p in range(max(0, -low), min(width, n - low)):
            if a[low + p] == char:
                match |= 1 << p
        diagonal = ((((match & plus) + plus) ^ plus) | match | minus) & full
        right_plus = (minus | ~(diagonal | plus)) & full
        right_minus = diagonal & plus
        if j < n - k:
            distance += not diagonal & bottom
        else:
            distance += bool(right_plus & last_row) - bool(right_minus & last_row)
            last_row >>= 1
        plus = (right_minus | ~((diagonal >> 1) | right_plus)) & full
        minus = (diagonal >> 1) & right_plus
    return distance <= k


def _table(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        corner, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            corner, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, corner + (x != y))
    return row[-1]


def segment(lengths: np.ndarray, parts: int, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the i-th of the even segments of lines of these lengths; the longer are last."""
    short, longer = lengths // parts, lengths % parts
    n_short = parts - longer
    start = np.where(i <= n_short, i * short, n_short * short + (i - n_short) * (short + 1))
    return start, np.where(i < n_short, short, short + 1)


def starts_to_probe(threshold: int, shorter_by: int, i: int) -> range:
    """Offsets from the start of segment i, of a line shorter by so much, at which a line is probed:
    the edits left of the segment are at most i, those right of it at most threshold - i."""
    left, right = i, threshold - i
    return range(max(-left, shorter_by - right), min(left, shorter_by + right) + 1)


def bucket_keys(lines: list[str], threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(line numbers, keys) for every length, segment and start."""
    lengths = np.array([len(line) for line in lines], dtype=np.int64)
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    flat = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    up, down = powers(len(flat) + 1)
    sums = np.zeros(len(flat) + 1, dtype=np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * up[: len(flat)], out=sums[1:])
    parts, all_lines = threshold + 1, np.arange(len(lines))
    for shorter_by in range(threshold + 1):
        other = lengths - shorter_by
        for i in range(parts):
            start, size = segment(other, parts, i)
            for offset in starts_to_probe(threshold, shorter_by, i):
                ok = (other >= parts) & (start + offset >= 0) & (start + offset + size <= lengths)
                at = (first + start + offset)[ok]
                code = (sums[at + size[ok]] - sums[at]) * down[at]
                yield all_lines[ok], mixed(mixed(code + other[ok].astype(np.uint64)) + np.uint64(i + 1))


def _lines(text: str | None, min_chars: int) -> list[tuple[int, str]]:
    """(place, line) of the lines that take part."""
    cut = [line.strip(SPACES) for line in text.split("\n")] if text else []
    return [(place, line) for place, line in enumerate(cut) if len(line) >= min_chars]


def line_code(lines: list[str]) -> np.ndarray:
    """64-bit codes of whole lines."""
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) for line in lines], np.uint64)


def _rows_of(docs: DataFrame, settings: Settings) -> DataFrame:
    """(bucket, node) of the lines; a line is given once per batch of documents."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _portions(batch.column(0)):
                lines = list(dict.fromkeys(line for text in texts for _, line in _lines(text, settings.min_chars)))
                if not lines:
                    continue
                nodes = line_code(lines).view(np.int64)
                keys = list(bucket_keys(lines, settings.threshold))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([key for _, key in keys]).view(np.int64)),
                        pa.array(nodes[np.concatenate([at for at, _ in keys])]),
                    ],
                    names=["bucket", "node"],
                )

    return docs.select("text").mapInArrow(split, "bucket long, node long")


def _portions(column: pa.Array, size: int = 1 << 20) -> Iterator[list[str | None]]:
    """The texts of a column, some megabytes at a time."""
    held, total = [], 0
    for value in column:
        text = value.as_py()
        held.append(text)
        total += len(text or "")
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def _line_texts(docs: DataFrame, settings: Settings) -> DataFrame:
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _portions(batch.column(0)):
                lines = list(dict.fromkeys(line for text in texts for _, line in _lines(text, settings.min_chars)))
                if lines:
                    nodes = pa.array(line_code(lines).view(np.int64))
                    yield pa.RecordBatch.from_arrays([nodes, pa.array(lines, pa.string())], names=["node", "line"])

    return docs.select("text").mapInArrow(split, "node long, line string")


PLACES = "doc_id long, doc_a long, doc_b long, place long, node long"


def _places(docs: DataFrame, settings: Settings) -> DataFrame:
    """Every line that takes part: its document, place and code."""
    min_chars = 1 if settings.exact_short else settings.min_chars

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_lines(value.as_py(), min_chars) for value in batch.column(3)]
            rows = pa.array(np.repeat(np.arange(len(batch)), [len(f) for f in found]))
            places = pa.array([place for f in found for place, _ in f], pa.int64())
            nodes = pa.array(line_code([line for f in found for _, line in f]).view(np.int64))
            ids = [batch.column(i).take(rows) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*ids, places, nodes], names=["doc_id", "doc_a", "doc_b", "place", "node"])

    return docs.select("doc_id", "doc_a", "doc_b", "text").mapInArrow(split, PLACES)


def _confirm(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            linked = [within(x, y, settings.threshold) for x, y in sides]
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    left = texts.select(F.col("node").alias("a"), F.col("line").alias("x"))
    right = texts.select(F.col("node").alias("b"), F.col("line").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _letters(lines: list[str]) -> np.ndarray:
    """How often each of 32 classes of characters is in each line."""
    counts = np.zeros((len(lines), 32), dtype=np.int32)
    flat = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4") % 32
    np.add.at(counts, (np.repeat(np.arange(len(lines)), [len(line) for line in lines]), flat), 1)
    return counts


def _group_links(rows: Rows, at: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links that join components of the lines of one group. Lines whose letters differ by more than
    two counts an edit are not compared."""
    nodes, blocks, lines, letters = (rows[c][at] for c in ("node", "block", "line", "letters"))
    within_block = rows["low"][at[0]] == rows["high"][at[0]]
    component, found = rows["component"][at].copy(), []
    for i in range(len(nodes) - 1):
        live = np.arange(i + 1, len(nodes))
        ok = component[live] != component[i]
        if not within_block:
            ok &= blocks[live] != blocks[i]
        live = live[ok]
        live = live[np.abs(letters[live] - letters[i]).sum(axis=1) <= 2 * threshold]
        for j in live.tolist():
            if component[i] != component[j] and within(lines[i], lines[j], threshold):
                found.append((int(min(nodes[i], nodes[j])), int(max(nodes[i], nodes[j]))))
                component[component == component[j]] = component[i]
    return found


def line_classes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(node, component) of the distinct lines that are near another one. ``docs`` has text."""
    # dealt by bucket once, for the count and for the join with it; the texts are read once
    rows = _rows_of(docs, settings).repartition("bucket")
    # of different lines: copies of a line share all its buckets and are one node
    shared = rows.groupBy("bucket").agg(F.min("node").alias("n0"), F.max("node").alias("n1")).where("n0 <> n1")
    members = stored(rows.join(shared.select("bucket"), "bucket").distinct().withColumn("size", F.lit(0)), "buckets")
    involved = stored(members.select("node").distinct(), "candidates")
    lines = _line_texts(docs, settings).join(growing(involved), "node", "left_semi")
    texts = stored(lines.groupBy("node").agg(F.first("line").alias("line")), "lines")
    labels = bucket_components(
        members, lambda pairs: _confirm(pairs, texts, settings),
        rest=lambda left: links_in_tasks(
            left, texts, lambda rows: rows | {"letters": _letters(rows["line"].tolist())},
            lambda rows, at: _group_links(rows, at, settings.threshold),
        ),
    )
    release(members, involved, texts)
    return labels


def _without_lines() -> Callable[[Column, Column], Column]:
    """The text without the lines at the given places, in one pass; null texts stay null."""

    @F.pandas_udf("string")
    def cut(text: pd.Series, gone: pd.Series) -> pd.Series:
        def kept(value, places):
            if value is None:
                return None
            out = set(places.tolist())
            return "\n".join(line for i, line in enumerate(value.split("\n")) if i not in out)

        return pd.Series([kept(*row) for row in zip(text, gone)], dtype=object)

    return cut


@cleaned
def dedup_lines(docs: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id",
                text: str = "text") -> DataFrame:
    """The documents (all columns) with the later lines of every class taken out, and the array of the
    places taken out, in a column ``places_removed`` (or a free name like it, the last column)."""
    keyed = small_batches(docs).select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text"),
        F.xxhash64(id_column, text).alias("doc_a"), unsigned_crc32(F.col(text)).alias("doc_b"),
    )
    labels = line_classes(keyed, settings)
    places = stored(_places(keyed, settings), "places")
    classed = places.join(labels, "node", "left").withColumn("class", F.coalesce("component", "node"))
    where = F.struct("doc_id", "place", "doc_a", "doc_b")
    first = classed.groupBy("class").agg(F.min(where).alias("first"))
    keys = ["doc_a", "doc_b", "place"]
    later = places.join(first.select(*[F.col(f"first.{k}") for k in keys]), keys, "left_anti")
    removed, name_a, name_b, name_r = (free_name(docs, n) for n in ("removed", "doc_a", "doc_b", "places_removed"))
    lists = later.groupBy("doc_a", "doc_b").agg(F.collect_set("place").alias(removed))  # as long as the document
    lists = lists.withColumnsRenamed({"doc_a": name_a, "doc_b": name_b})
    named = docs.withColumns({name_a: F.xxhash64(id_column, text), name_b: unsigned_crc32(F.col(text))})
    met = named.join(growing(lists), [name_a, name_b], "left")
    gone = F.coalesce(removed, F.array().cast("array<bigint>"))
    cut = F.size(gone) > 0
    left = _without_lines()(F.when(cut, F.col(text)), gone)
    new_text = F.when(cut, left).otherwise(F.col(text))
    columns = [new_text.alias(text) if c == text else F.col(c) for c in docs.columns]
    return met.select(*columns, F.array_sort(gone).alias(name_r))
