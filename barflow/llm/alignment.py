"""Tokens of two tokenizers over the same bytes: groups that both end together, and corpus-wide links.

Both token lists of a text cover the same bytes. Interval coalescing: the tokens of both sides are
sorted by start (lexsort), the largest end so far is kept (maximum.accumulate), and a group breaks
where a start reaches it, that is where both sides end. Inside a group the overlaps expand to links,
one for each A token and B token that share a byte.

Neither tokenizer joins bytes across a blank that stands between two characters other than white
space (checked for B's vocabulary when it is loaded; A's split pattern rules it out), so a text is
cut there into units; units are aligned once per worker and batch of texts, and texts put together from them.

Counts over the corpus are Spark aggregations of the distinct links of each text. Texts get them back
by a join: the most frequent pairs, at most ``HEAD_PAIRS``, are broadcast; the rest is joined by shuffle.

Defined results: null and empty texts, and those whose bytes a tokenizer does not give back, have no
tokens: zeros and an empty digest; repeated rows, also of one id, are texts of their own and count
once each; an empty table gives an empty table; of very long texts one piece of ``CHUNK_BYTES`` is
in work at a time, unless a single unit is longer; further columns are dropped, so names cannot clash.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import growing, stored
from barflow.llm.packing import tokenizer

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Pairs that are sent to all tasks: at most 16 bytes each.
HEAD_PAIRS = 1 << 18
CHUNK_BYTES = 1 << 20
CACHE_UNITS = 300_000
#: The piece-side marker of a blank.
BLANK = "▁"


@dataclass(frozen=True)
class Aligned:
    """Groups and links of token lists laid end to end."""

    a_group: np.ndarray  # group of each A token
    b_group: np.ndarray
    link_a: np.ndarray  # places of the tokens of each link
    link_b: np.ndarray


def coalesce(a_lengths: np.ndarray, b_lengths: np.ndarray) -> Aligned:
    """Align two lists of token lengths in bytes that cover the same bytes."""
    a_end, b_end = np.cumsum(a_lengths), np.cumsum(b_lengths)
    a_start, b_start = a_end - a_lengths, b_end - b_lengths
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    side = np.repeat([0, 1], [len(a_start), len(b_start)])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.ones(len(order), dtype=np.int64)
    breaks[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(breaks) - 1
    # of a group's B tokens, those from the one that ends behind the A token's start to the last that starts before its end
    first, stop = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_start, a_end, "left")
    n = stop - first
    link_a = np.repeat(np.arange(len(n)), n)
    link_b = np.arange(len(link_a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    return Aligned(group[: len(a_start)], group[len(a_start) :], link_a, link_b)


#: A blank, or the text's start, before white space or the end: not a place to cut.
UNEVEN = re.compile(r"(?:\A| )(?:\s|\Z)")


def units_of(text: str) -> list[str]:
    """Stretches behind single blanks that neither side joins; each stands for a blank and itself."""
    words = text.split(" ")
    if not UNEVEN.search(text):
        return words
    units, before = words[:1], words[0]
    for word in words[1:]:
        if word and before and not word[0].isspace():
            units.append(word)
        else:
            units[-1] += " " + word
        before = word
    return units


def rendered(group: np.ndarray, side: np.ndarray, unit: np.ndarray, ids: np.ndarray, units: int) -> list[str]:
    """`a1,a2|b1;a3|b2` of every unit; tokens come in order of group and side."""
    if not len(ids):
        return [""] * units
    code = np.zeros(len(ids), dtype=np.int64)  # what follows a token: the same side, the other, a group, a unit
    code[:-1] = np.select([unit[1:] != unit[:-1], group[1:] != group[:-1], side[1:] != side[:-1]], [3, 2, 1], 0)
    parts = [""] * (2 * len(ids) - 1)
    parts[0::2] = list(map(str, ids.tolist()))
    parts[1::2] = np.array([",", "|", ";", "\n"], dtype=object)[code[:-1]].tolist()
    out = [""] * units
    for number, text in zip(np.unique(unit).tolist(), "".join(parts).split("\n"), strict=True):
        out[number] = text
    return out


class Aligner:
    """Units known so far, with their counts, links and digest text."""

    def __init__(self, ranks_path: str, pattern: str, model_path: str):
        import sentencepiece

        self.a = tokenizer(ranks_path, pattern).encoding
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.cuts = not any(BLANK in piece.lstrip(BLANK) for piece in pieces)
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)
        ]
        self.b_lengths = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.a_lengths = np.zeros(self.a.n_vocab, dtype=np.int64)
        for i in range(self.a.n_vocab):
            try:
                self.a_lengths[i] = len(self.a.decode_single_token_bytes(i))
            except KeyError:
                continue
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.texts: list[str] = []
        self.counts = np.zeros((0, 4), dtype=np.int64)  # tokens of A and B, groups, links
        self.good = np.zeros(0, dtype=bool)
        self.pairs = np.zeros(0, dtype=np.int64)
        self.firsts = np.zeros(1, dtype=np.int64)  # where each unit's pairs begin

    def given_back(self, fresh: list[str], ids: list[list[int]], flat: np.ndarray) -> np.ndarray:
        """Whether B's bytes are those of each unit behind its blank."""
        whole = [(" " + unit).encode() for unit in fresh]
        ends = np.cumsum([len(x) for x in whole])
        mine = np.concatenate([[0], np.cumsum(self.b_lengths[flat])])[np.cumsum([len(x) for x in ids])]
        if (ends == mine).all() and b"".join([self.b_bytes[i] for i in flat.tolist()]) == b"".join(whole):
            return np.ones(len(fresh), dtype=bool)
        return np.array([b"".join([self.b_bytes[i] for i in x]) == y for x, y in zip(ids, whole, strict=True)], dtype=bool)

    def learn(self, fresh: list[str]) -> None:
        """Align units not seen before."""
        flat = lambda ids: np.fromiter(itertools.chain.from_iterable(ids), dtype=np.int64)
        a_ids = [self.a.encode_ordinary(" " + unit) for unit in fresh]
        b_ids = self.b.encode(fresh, num_threads=1)
        good = self.given_back(fresh, b_ids, flat(b_ids))
        if not good.all():
            a_ids, b_ids = ([x if ok else [] for x, ok in zip(ids, good, strict=True)] for ids in (a_ids, b_ids))
        n_a, n_b = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (a_ids, b_ids))
        a, b = flat(a_ids), flat(b_ids)
        aligned = coalesce(self.a_lengths[a], self.b_lengths[b])
        numbers = np.arange(len(fresh))
        a_unit, b_unit = np.repeat(numbers, n_a), np.repeat(numbers, n_b)
        n_links = np.bincount(a_unit[aligned.link_a], minlength=len(fresh))
        n_groups = np.bincount(a_unit[np.flatnonzero(np.diff(aligned.a_group, prepend=-1))], minlength=len(fresh))
        group, side = np.concatenate([aligned.a_group, aligned.b_group]), np.repeat([0, 1], [len(a), len(b)])
        order = np.lexsort((side, group))
        texts = rendered(group[order], side[order], np.concatenate([a_unit, b_unit])[order], np.concatenate([a, b])[order], len(fresh))
        self.known.update(zip(fresh, range(len(self.texts), len(self.texts) + len(fresh)), strict=True))
        self.texts += texts
        self.counts = np.vstack([self.counts, np.column_stack([n_a, n_b, n_groups, n_links])])
        self.good = np.concatenate([self.good, good])
        pairs = a[aligned.link_a] * len(self.b_bytes) + b[aligned.link_b]
        self.pairs = np.concatenate([self.pairs, pairs])
        self.firsts = np.concatenate([self.firsts, self.firsts[-1] + np.cumsum(n_links)])

    def prepare(self, units: list[str]) -> None:
        """Learn the units that are new, all at once."""
        fresh = [unit for unit in dict.fromkeys(units) if unit not in self.known]
        if len(self.known) + len(fresh) > CACHE_UNITS:
            self.forget()
            fresh = list(dict.fromkeys(units))
        if fresh:
            self.learn(fresh)

    def units(self, units: list[str]) -> np.ndarray:
        """Numbers of the units, learned where they are new."""
        known = self.known
        try:
            return np.array([known[unit] for unit in units], dtype=np.int64)
        except KeyError:
            self.prepare(units)
            return np.array([self.known[unit] for unit in units], dtype=np.int64)

    def each(self, texts: list[str]) -> Iterator[tuple[list[int], str, np.ndarray, np.ndarray]]:
        """``text`` of all of them; new units of about ``CHUNK_BYTES`` of texts are learned together."""
        held, size = [], 0
        for text in [*texts, None]:
            if held and (text is None or size + len(text) > CHUNK_BYTES):
                cut = [self.cut(body) for body in held]
                if size <= CHUNK_BYTES:
                    self.prepare(list(itertools.chain.from_iterable(cut)))
                for body, units in zip(held, cut, strict=True):
                    yield self.text(body, units)
                held, size = [], 0
            if text is not None:
                held.append(text)
                size += len(text)

    def cut(self, text: str) -> list[str]:
        return [] if not text else units_of(text) if self.cuts else [text]

    def text(self, text: str, units: list[str]) -> tuple[list[int], str, np.ndarray, np.ndarray]:
        """Counts, digest, distinct pairs and how often each is linked; all empty if the bytes are not given back."""
        nothing = [0, 0, 0, 0], "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not text:
            return nothing
        total, digest, held = np.zeros(4, np.int64), hashlib.sha256(), []
        step = len(units) if len(text) <= CHUNK_BYTES else max(1, len(units) * CHUNK_BYTES // len(text))
        for at in range(0, len(units), step):
            number = self.units(units[at : at + step])
            if not self.good[number].all():
                return nothing
            digest.update(((";" if at else "") + ";".join([self.texts[i] for i in number.tolist()])).encode())
            distinct, times = np.unique(number, return_counts=True)
            total += (self.counts[distinct] * times[:, None]).sum(axis=0)
            held.append(summed(*self.links(distinct, times)))
        pairs, times = held[0] if len(held) == 1 else summed(*map(np.concatenate, zip(*held, strict=True)))
        return total.tolist(), digest.hexdigest(), pairs, times

    def links(self, units: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = self.firsts[units + 1] - self.firsts[units]
        place = np.arange(n.sum()) + np.repeat(self.firsts[units] - (np.cumsum(n) - n), n)
        return self.pairs[place], np.repeat(times, n)


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values, first)


ALIGNERS: dict[tuple, Aligner] = {}


def aligner(*files: str) -> Aligner:
    if files not in ALIGNERS:
        ALIGNERS[files] = Aligner(*files)
    return ALIGNERS[files]


ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<bigint>, times array<int>"


def aligned_texts(docs: DataFrame, ranks_path: str, pattern: str, model_path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text's counts, digest and distinct links; a link's pair is A's id times B's vocabulary size plus B's id."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(ranks_path, pattern, model_path)
        names = [part.split()[0] for part in ALIGNED.split(", ")]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                counts, digests, pairs, times = zip(*work.each([body or "" for body in part.column(2).to_pylist()]), strict=True)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in pairs])]).astype(np.int32)
                columns = [part.column(0), part.column(1), *[pa.array(c, type=pa.int64()) for c in zip(*counts, strict=True)], pa.array(digests, type=pa.string())]
                columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(pairs))))
                columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(times).astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("bigint"), F.col(text))
    return rows.mapInArrow(align, ALIGNED)


def pair_counts(texts: DataFrame, b_size: int) -> DataFrame:
    """pair, a, b, n (texts that hold it linked) and whether no pair of the A id has more."""
    counts = texts.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    named = counts.select("pair", F.expr(f"pair div {b_size}").alias("a"), (F.col("pair") % b_size).alias("b"), "n")
    best = named.groupBy("a").agg(F.max("n").alias("most"))
    return named.join(best, "a").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def head_threshold(pairs: DataFrame, most: int) -> int:
    """The least power of two so that at most ``most`` pairs have that count or more."""
    steps = pairs.groupBy(F.floor(F.log2(F.col("n").cast("double"))).alias("step")).agg(F.count(F.lit(1)).alias("pairs"))
    left, found = most, 0
    by_step = {r["step"]: r["pairs"] for r in steps.collect()}  # one line per power of two
    for step in range(max(by_step, default=0), -1, -1):
        left -= by_step.get(step, 0)
        if left < 0:
            found = step + 1
            break
    return 2**found


def align(docs: DataFrame, ranks_path: str, pattern: str, model_path: str, b_size: int, id_column: str = "doc_id",
          text: str = "text", head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """Counts of tokens, groups and links of every text, how its links stand in the corpus, and the digest of its groups.

    ``b_size`` is the number of B's pieces. Writes the aligned texts and the pairs below the shared folder.
    """
    texts = stored(aligned_texts(docs, ranks_path, pattern, model_path, id_column, text), "aligned")
    pairs = stored(pair_counts(texts, b_size), "pairs").select("pair", "n", "best")
    least = head_threshold(pairs, head_pairs)
    head = F.broadcast(pairs.where(F.col("n") >= least))  # at most head_pairs lines
    links = texts.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    links = links.select("row", F.col("link.pairs").alias("pair"), F.col("link.times").cast("bigint").alias("times"))
    tail = F.when(F.col("n").isNull(), F.col("pair")).alias("tail")
    n_best, total = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum")
    # frequent pairs melt into one line per text; rare ones keep a line each and are joined by shuffle
    met = stored(links.join(head, "pair", "left").groupBy("row", tail).agg(n_best, total, F.sum("times").alias("times")), "links")
    rare = met.where("tail IS NOT NULL").select("row", F.col("tail").alias("pair"), "times").join(growing(pairs), "pair")
    parts = met.where("tail IS NULL").select("row", "n_best", "count_sum").unionByName(rare.groupBy("row").agg(n_best, total))
    sums = parts.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("bigint")
    return texts.drop("pairs", "times").join(growing(sums), "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
