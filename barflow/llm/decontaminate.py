"""Benchmark decontamination by greedy string tiling.

Words (runs of letters, digits and non-ASCII bytes, A-Z lowered) of every whole text are compared
with each benchmark item. Karp-Rabin fingerprints of ``min_match`` words find the shared seeds;
seeds that follow each other on one diagonal are maximal common matches. The longest match whose
words are free on both sides is marked as a tile, matches that a tile cuts into are shortened and put
back, until none of ``min_match`` words is left. Tiles may lie in any order, so passages put together
anew are found too. An item leaks into a text when its tiles cover ``coverage`` of the item's words.

The benchmark is the stated query set: it is read in blocks of a bounded number of bytes, each block
is sent to the tasks whole, and every text meets every block. Texts are never shuffled.

Defined results: a null or empty text has no matches; items that are null or shorter than
``min_match`` words cannot be matched (their wording is no evidence); equal items are matched each;
repeated rows are judged one by one; all columns of the documents pass through and the matches get
a free column name; empty tables on either side give no matches.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.llm.common import free_name, small_batches
from barflow.llm.wordcodes import shingles, word_chunks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_MATCH = 5
COVERAGE = 0.6
BLOCK_BYTES = 8 << 20
#: Bytes of words: letters, digits, everything beyond ASCII.
WORD_BYTES = np.zeros(256, dtype=bool)
WORD_BYTES[48:58] = WORD_BYTES[65:91] = WORD_BYTES[97:123] = WORD_BYTES[128:] = True

TILE = T.StructType(
    [T.StructField("item_start", T.LongType()), T.StructField("doc_start", T.LongType()), T.StructField("length", T.LongType())]
)
MATCHES = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()), T.StructField("item_words", T.LongType()),
            T.StructField("covered", T.LongType()), T.StructField("tiles", T.ArrayType(TILE)),
        ]
    )
)


@dataclass
class Index:
    """Seeds of one block of items: sorted codes with the item and place of each."""

    ids: list[int | None]
    lengths: np.ndarray
    codes: np.ndarray
    items: np.ndarray
    places: np.ndarray

    @staticmethod
    def of(rows: list[tuple[int | None, str | None]], min_match: int) -> Index:
        ids, lengths, codes, items, places = [], [], [], [], []
        for item_id, text in rows:
            words = next(word_chunks(pa.array([text], pa.string()), WORD_BYTES), None)
            if words is None or len(words.codes) < min_match:
                continue
            seeds, _ = shingles(words, min_match)
            items.append(np.full(len(seeds), len(ids)))
            places.append(np.arange(len(seeds)))
            codes.append(seeds)
            ids.append(item_id)
            lengths.append(len(words.codes))
        if not ids:
            none = np.zeros(0, np.int64)
            return Index([], none, none.astype(np.uint64), none, none)
        flat = np.concatenate(codes)
        order = np.argsort(flat, kind="stable")
        return Index(ids, np.array(lengths), flat[order], np.concatenate(items)[order], np.concatenate(places)[order])


def tile(item_at: np.ndarray, doc_at: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Tiles (item start, doc start, length) from the places of all shared seeds, longest first; of
    equally long matches the one that is first in the text, then in the item."""
    order = np.lexsort((item_at, doc_at - item_at))
    i, d = item_at[order], doc_at[order]
    fresh = np.ones(len(i), dtype=bool)
    fresh[1:] = (i[1:] != i[:-1] + 1) | (d[1:] != d[:-1] + 1)
    begin = np.flatnonzero(fresh)
    length = np.diff(np.append(begin, len(i))) + min_match - 1
    heap = [(-int(n), int(d[b]), int(i[b])) for b, n in zip(begin, length, strict=True)]
    heapq.heapify(heap)
    used_item, used_doc, tiles = set(), set(), []
    while heap:
        n, at, start = heapq.heappop(heap)
        run, free = 0, []
        for k in range(-n + 1):
            if k < -n and start + k not in used_item and at + k not in used_doc:
                run += 1
                continue
            if run >= min_match:
                free.append((k - run, run))
            run = 0
        if free == [(0, -n)]:
            tiles.append((start, at, -n))
            used_item.update(range(start, start - n))
            used_doc.update(range(at, at - n))
        else:
            for k, run in free:
                heapq.heappush(heap, (-run, at + k, start + k))
    return tiles


def _found(index: Index, hits: np.ndarray, doc_at: np.ndarray, min_match: int, coverage: float) -> list[dict]:
    """Leaking items of one text, from the codes of its seeds that some item has."""
    first = np.searchsorted(index.codes, hits, side="left")
    count = np.searchsorted(index.codes, hits, side="right") - first
    at = np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
    item, place, doc = index.items[at], index.places[at], np.repeat(doc_at, count)
    order = np.argsort(item, kind="stable")
    item, place, doc = item[order], place[order], doc[order]
    found = []
    for begin, end in zip(*_runs(item), strict=True):
        one = int(item[begin])
        total = int(index.lengths[one])
        # no tiling covers more words than the seeds do together
        seeds = np.unique(place[begin:end])
        most = int(np.minimum(np.diff(np.append(seeds, seeds[-1] + min_match)), min_match).sum())
        if most < coverage * total:
            continue
        tiles = tile(place[begin:end], doc[begin:end], min_match)
        covered = sum(n for _, _, n in tiles)
        if covered >= coverage * total:
            spans = [dict(item_start=i, doc_start=d, length=n) for i, d, n in sorted(tiles)]
            found.append(dict(item_id=index.ids[one], item_words=total, covered=covered, tiles=spans))
    return found


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return begin, np.append(begin[1:], len(keys)) if len(keys) else begin


def _matcher(index: Index, place: int, earlier: int | None, name: str, min_match: int, coverage: float):
    """One pass over Arrow batches: the text column is at ``place``, matches so far at ``earlier``."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(earlier).to_pylist() if earlier is not None else [[] for _ in range(len(batch))]
            for words in word_chunks(batch.column(place), WORD_BYTES):
                if not len(index.codes) or not len(words.codes):
                    continue
                codes, bounds = shingles(words, min_match)
                at = np.minimum(np.searchsorted(index.codes, codes), len(index.codes) - 1)
                hit = np.flatnonzero(index.codes[at] == codes)
                row = np.searchsorted(bounds, hit, side="right") - 1
                for begin, end in zip(*_runs(row), strict=True):
                    one = int(row[begin])
                    places = hit[begin:end] - bounds[one]
                    rows[words.first_row + one] += _found(index, codes[hit[begin:end]], places, min_match, coverage)
            kept = [c for i, c in enumerate(batch.columns) if i != earlier]
            names = [n for i, n in enumerate(batch.schema.names) if i != earlier]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, ARROW_MATCHES)], names=[*names, name])

    return match


ARROW_MATCHES = pa.list_(
    pa.struct(
        [
            ("item_id", pa.int64()), ("item_words", pa.int64()), ("covered", pa.int64()),
            ("tiles", pa.list_(pa.struct([("item_start", pa.int64()), ("doc_start", pa.int64()), ("length", pa.int64())]))),
        ]
    )
)


def with_matches(docs: DataFrame, benchmark: DataFrame, matches: str, text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", min_match: int = MIN_MATCH, coverage: float = COVERAGE,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with a column of their leaks: item, its words, words covered, and the tiles."""
    items = benchmark.select(F.col(item_id).cast("bigint").alias("item"), F.col(item_text).alias("body")).where(
        "body IS NOT NULL"
    )
    size = items.agg(F.sum(F.octet_length("body") + 16)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes) * (2 if size > block_bytes else 1))  # dealt by hash: half full
    out, earlier = small_batches(docs), None
    shape = T.StructType([*docs.schema.fields, T.StructField(matches, MATCHES)])
    for block in range(blocks):
        held = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == block).collect()  # bounded by block_bytes
        index = Index.of([(r["item"], r["body"]) for r in held], min_match)
        out = out.mapInArrow(_matcher(index, docs.columns.index(text), earlier, matches, min_match, coverage), shape)
        earlier = len(docs.columns)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text",
                  **settings) -> DataFrame:
    """Per document: leaking items, the one covered most (then the least id) and its coverage."""
    found = with_matches(docs.select(id_column, text), benchmark, "matches", text, **settings)
    share = lambda m: m["covered"] / m["item_words"]
    ranked = F.array_max(F.transform("matches", lambda m: F.struct(share(m).alias("share"), (-m["item_id"]).alias("item"))))
    return found.select(
        id_column,
        F.size("matches").cast("bigint").alias("n_items"),
        (-ranked["item"]).alias("item_id"),
        F.coalesce(ranked["share"], F.lit(0.0)).alias("coverage"),
        (F.size("matches") > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **settings) -> DataFrame:
    """The documents without a leak, with all their columns."""
    matches = free_name(docs, "matches")
    return with_matches(docs, benchmark, matches, text, **settings).where(F.size(matches) == 0).select(*docs.columns)
