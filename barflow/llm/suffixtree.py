"""Scores of whole texts under a probabilistic suffix tree of words.

Symbols are all words and the end of a text. States are contexts of up to ``max_order`` symbols that were
seen ``min_count`` times in training. A state is retained if its next-symbol counts diverge from its
parent's distribution (the context without its first symbol) by more than the counts' description
costs: sum of c * ln(p / parent) over half a ln(N) for each count. A retained state gives
    (c(s, w) + m * parent(w)) / (c(s) + m)
to every symbol w, m being the number of different symbols seen after it; a state that is not retained passes
its parent on. The root gives (c + 1) / (N + V + 1), the base model. A token is scored by its longest
suffix state.

Tree and counts grow with the corpus. Documents are held in blocks of some megabytes, as numbers into
the block's own words. A block asks about each different entry (context, next symbol) it holds, once; the
questions are dealt by context to groups, which count, test and smooth, and the answers go back to the block. So
no row moves for each token, and a frequent entry comes once a block. A context with ``HOT`` or more tokens is
dealt over all groups by its next symbols; sums over the groups give its state before they answer. How often a
longer context was seen is the count of the entry one order down; contexts below ``min_count`` are never asked about.

The tokens are dealt into ``PARTS`` by the word before them, so that a context lies in one part with all
that comes after it. Parts are learned and scored one after another and leave only the sums of their
texts, so the disk holds the questions of one part.

``fit`` learns a model that is bounded whatever the corpus (symbols and states with ``min_share`` of the
tokens, counts with ``count_share``, all else in a rest symbol), for use in one process; texts are not
scored by it.

Defined results: a null or empty text is its end token; a null id counts as empty text for the split;
every row is given back once, whatever its id; an empty
training table leaves only the root with N = V = 0; only named columns are read.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import cleaned, growing, release, small_batches, stored, text_or_empty
from barflow.llm.wordcodes import Words, mixed, word_chunks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

END = mixed(np.array([0x656E64], dtype=np.uint64))[0]
TALLY_KEYS = 1 << 21
#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 1 << 22
#: Questions in a group, about.
GROUP = 1 << 19
#: Training tokens from which a context is dealt over all groups.
HOT = 1 << 19
#: Parts of the tokens, by the word before each, that are learned and scored one after another.
PARTS = 4


@dataclass(frozen=True)
class Settings:
    min_share: float = 1e-4
    count_share: float = 1e-6
    max_order: int = 2
    min_count: int = 5


@dataclass
class Order:
    """Candidate contexts of one length, found by their first symbol and their suffix's number."""

    keys: np.ndarray  # sorted: first symbol * number of shorter contexts + number of the suffix
    parent: np.ndarray  # number of the suffix, by context
    total: np.ndarray
    entry_keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # context * symbols + symbol
    entry_p: np.ndarray = field(default_factory=lambda: np.zeros(0))
    share: np.ndarray = field(default_factory=lambda: np.ones(0))  # of the parent's probability, for other symbols
    retained: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))


@dataclass
class Model:
    n: int
    v: int
    head_codes: np.ndarray  # words with known counts, sorted
    head_counts: np.ndarray
    symbols: np.ndarray  # sorted codes of the symbols; symbol k is symbols[k - 1], 0 the rest
    root: np.ndarray
    orders: list[Order]

    def symbol_ids(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.symbols):
            return np.zeros(len(codes), np.int64)
        at = np.minimum(np.searchsorted(self.symbols, codes), len(self.symbols) - 1)
        return np.where(self.symbols[at] == codes, at + 1, 0)

    def contexts(self, ids: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        """For each order, the number of the candidate context before each token, or -1."""
        end = self.symbol_ids(np.array([END]))[0]
        found, shorter, n_shorter = [], np.zeros(len(ids), np.int64), 1
        old = ids
        for k, order in enumerate(self.orders, 1):
            # the symbol k places before; what lies before the text are ends
            old = np.concatenate(([end], old[:-1]))
            if k > 1:
                old[starts] = end
            key = old * n_shorter + shorter
            at = np.minimum(np.searchsorted(order.keys, key), max(0, len(order.keys) - 1))
            hit = (order.keys[at] == key) & (shorter >= 0) if len(order.keys) else np.zeros(len(ids), bool)
            shorter, n_shorter = np.where(hit, at, -1), len(order.keys)
            found.append(shorter)
        return found

    def probability(self, contexts: list[np.ndarray], ids: np.ndarray) -> np.ndarray:
        """Of each symbol after its longest state; ``contexts`` from short to long."""
        p = self.root[ids]
        for order, context in zip(self.orders, contexts, strict=False):
            if not len(order.share):
                continue
            inside = context >= 0
            p = np.where(inside, p * order.share[context], p)
            if len(order.entry_keys):
                key = context * len(self.root) + ids
                at = np.minimum(np.searchsorted(order.entry_keys, key), len(order.entry_keys) - 1)
                p = np.where(inside & (order.entry_keys[at] == key), order.entry_p[at], p)
        return p


def held_out(id_column: str | Column) -> Column:
    """The remainder of the id's checksum modulo 7 is 2."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(F.encode(F.coalesce(column.cast("string"), F.lit("")), "UTF-8")) % 7 == 2


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Codes with the end after each row's words, and the bounds by row."""
    rows = len(words.bounds) - 1
    bounds = words.bounds + np.arange(rows + 1)
    codes = np.empty(bounds[-1], dtype=np.uint64)
    is_end = np.zeros(len(codes), dtype=bool)
    is_end[bounds[1:] - 1] = True
    codes[is_end], codes[~is_end] = END, words.codes
    return codes, bounds


def _tally(texts: DataFrame, keys_of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(key, n): how often ``keys_of`` (codes, row starts) gives each key, over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        fresh, size = [], 0

        def merged() -> None:
            nonlocal keys, counts, size
            new, n = np.unique(np.concatenate(fresh), return_counts=True)
            joined = np.concatenate([keys, new])
            keys, which = np.unique(joined, return_inverse=True)
            counts = np.bincount(which, np.concatenate([counts, n]), len(keys)).astype(np.int64)
            fresh.clear()
            size = 0

        def given() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "n"])

        for batch in batches:
            for words in word_chunks(batch.column(0)):
                codes, bounds = tokens(words)
                fresh.append(keys_of(codes, bounds[:-1]).astype(np.int64, copy=False))
                size += len(fresh[-1])
                if size >= TALLY_KEYS:
                    merged()
                    if len(keys) >= TALLY_KEYS:
                        yield given()
                        keys, counts = keys[:0], counts[:0]
        if fresh:
            merged()
        if len(keys):
            yield given()

    return texts.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _columns(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    table = df.toArrow()  # bounded by a minimum share of the tokens
    return table.column(0).to_numpy(), table.column(1).to_numpy()


def _learn_order(model: Model, order: Order, keys: np.ndarray, counts: np.ndarray, depth: int) -> None:
    """Entries and shares of the contexts of one order, from (context * symbols + symbol) counts."""
    width = len(model.root)
    by = np.argsort(keys)
    keys, counts = keys[by], counts[by]
    context, symbol = keys // width, keys % width
    n_contexts = len(order.keys)
    # the parent's probability: the chain of suffixes, long to short
    chain, at = [], order.parent[context]
    for shorter in reversed(model.orders[:depth]):
        chain.insert(0, at)
        at = shorter.parent[at]
    before = model.probability(chain, symbol)
    m = np.bincount(context, minlength=n_contexts)
    p = counts / order.total[context]
    gain = np.bincount(context, counts * np.log(p / before), n_contexts)
    rest = order.total - np.bincount(context, counts, n_contexts)
    rest_before = np.maximum(1 - np.bincount(context, before, n_contexts), 1e-12)
    gain += np.where(rest > 0, rest * np.log(np.maximum(rest, 1) / order.total / rest_before), 0)
    order.retained = gain > 0.5 * m * np.log(max(model.n, 2))
    smoothed = (counts + m[context] * before) / (order.total[context] + m[context])
    left = np.maximum(1 - np.bincount(context, smoothed, n_contexts), 0)
    order.share = np.where(order.retained, np.maximum(left / rest_before, 1e-9), 1.0)
    keep = order.retained[context]
    order.entry_keys, order.entry_p = keys[keep], smoothed[keep]


def fit(texts: DataFrame, settings: Settings = Settings()) -> tuple[Model, DataFrame]:
    """The model and the table of all word counts (key, n). ``texts`` has one column of texts."""
    counts = stored(_tally(texts, lambda codes, _: codes.view(np.int64)), "word_counts")
    n, v = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    n = n or 0
    keys, known = _columns(counts.where(F.col("n") >= settings.count_share * n))
    by = np.argsort(keys.view(np.uint64))
    head, known = keys.view(np.uint64)[by], known[by]
    often = known >= settings.min_share * n
    total = n + v + 1
    p = (known[often] + 1) / total
    model = Model(n, v, head, known, head[often], np.concatenate(([max(1 - p.sum(), 1 / total)], p)), [])
    strings = {(k,): c for k, c in enumerate(known[often].tolist(), 1)}
    strings[(0,)] = n - int(known[often].sum())
    shorter = {(): 0}
    for depth in range(settings.max_order if len(head) else 0):
        width, n_shorter = len(model.root), len(shorter)
        found = sorted(
            (s[0] * n_shorter + shorter[s[1:]], s) for s, c in strings.items() if c >= settings.min_share * n and s[1:] in shorter
        )
        order = Order(
            np.array([k for k, _ in found], dtype=np.int64),
            np.array([shorter[s[1:]] for _, s in found], dtype=np.int64),
            np.array([strings[s] for _, s in found], dtype=np.float64),
        )
        model.orders.append(order)

        def keys_of(codes: np.ndarray, starts: np.ndarray, model=model, width=width) -> np.ndarray:
            ids = model.symbol_ids(codes)
            context = model.contexts(ids, starts)[-1]
            return (context * width + ids)[context >= 0]

        grown = _tally(texts, keys_of).where(F.col("n") >= settings.count_share * n)
        entry_keys, entry_counts = _columns(grown)
        # an end of a text is also the context of the next one's first token
        _learn_order(model, order, entry_keys, entry_counts, depth)
        names = [s for _, s in found]
        strings = {
            (*names[k // width], int(k % width)): c
            for k, c in zip(entry_keys.tolist(), entry_counts.tolist(), strict=True)
            if c >= settings.min_share * n
        }
        shorter = {s: i for i, s in enumerate(names)}
    return model, counts


def _after(context: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Keys of the entries (context, next symbol); the next token's context one order up has the same."""
    return mixed(mixed(context + np.uint64(0x9FB21C651E98DF25)) ^ codes)


def _entries(codes: np.ndarray, starts: np.ndarray, orders: int, part: int | None = None) -> Iterator[tuple]:
    """For each order from 1, by token: (entry, entry one order down, context, whether it lies in the part, if one is
    given). What lies before a text are ends."""
    lower, at_start, inside = codes, END, np.ones(len(codes), bool)
    for k in range(orders):
        context = np.concatenate(([at_start], lower[:-1]))
        context[starts] = at_start
        if not k and part is not None:
            inside = context % np.uint64(PARTS) == part
        entry = _after(context, codes)
        yield entry, lower, context, inside
        lower, at_start = entry, _after(np.array([at_start]), np.array([END]))[0]


def _counted(read: DataFrame, keys_of: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, ...]], *names: str) -> DataFrame:
    """The columns that ``keys_of`` (codes, row starts) gives, once for each value of the first, and n: how often over
    all texts; n counts training tokens only."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh, size = [], 0

        def given() -> pa.RecordBatch:
            *keys, n = (np.concatenate(part) for part in zip(*fresh, strict=True))
            fresh.clear()
            _, first, which = np.unique(keys[0], return_index=True, return_inverse=True)
            total = np.bincount(which, n, len(first)).astype(np.int64)
            columns = [pa.array(c[first].view(np.int64)) for c in keys]
            return pa.RecordBatch.from_arrays([*columns, pa.array(total)], names=[*names, "n"])

        for batch in batches:
            train = batch.column(0).to_numpy(zero_copy_only=False)
            for words in word_chunks(batch.column(1)):
                codes, bounds = tokens(words)
                *keys, inside = keys_of(codes, bounds[:-1])
                rows = len(bounds) - 1
                n = np.repeat(train[words.first_row : words.first_row + rows], np.diff(bounds))
                fresh.append(tuple(c[inside] for c in (*keys, n)))
                size += len(fresh[-1][0])
                if size >= TALLY_KEYS:
                    yield given()
                    size = 0
        if fresh:
            yield given()

    rows = read.select(~held_out("doc_id"), "text").mapInArrow(count, ", ".join(f"{c} long" for c in (*names, "n")))
    return rows.groupBy(names[0]).agg(*[F.first(c).alias(c) for c in names[1:]], F.sum("n").alias("n"))


def _count_contexts(read: DataFrame, shorter: list) -> DataFrame:
    """(entry, n) of the order above those in ``shorter``, as a table."""

    def keys_of(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        for entry, _, _, inside in _entries(codes, starts, len(shorter) + 1):
            pass
        return entry, inside

    return _counted(read, keys_of, "entry")


def _count_entries(read: DataFrame, shorter: list, part: int) -> DataFrame:
    """(entry, lower, context, n) of the order above those in ``shorter``, over the tokens of a part, as a table."""

    def keys_of(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        for found in _entries(codes, starts, len(shorter) + 1, part):
            pass
        return found

    return _counted(read, keys_of, "entry", "lower", "context")


CODEC = partial(pa.Codec, "zstd", compression_level=1)
BLOCKS = ("block long, doc_id array<long>, train binary, bounds binary, symbols binary, counts binary, ids binary, marks binary, "
          "hottest int, n_tokens long, n_symbols long")
QUESTIONS = "to long, block long, context binary, entry binary, before binary, times binary"
ANSWERS = "block long, level int, to long, answer binary, n long, v long"
ROWS = "block long, row long, doc_id long, n_tokens long, n_known long, base_score double"
SCORES = "block long, row long, score double"
STATES = "context long, total long, m long, gain double"


def _batch(schema: str, columns: dict) -> pa.RecordBatch:
    """A batch of the columns named in ``schema``; columns not given are null."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in schema.split(", ")]
    rows = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns.get(name, [None] * rows), kinds[kind]) for name, kind in fields], names=[name for name, _ in fields]
    )


def _packed(numbers: np.ndarray) -> bytes:
    """Its size in bytes and what it compresses to."""
    return np.int64(numbers.nbytes).tobytes() + CODEC().compress(np.ascontiguousarray(numbers), asbytes=True)


def _size(packed: pa.BinaryScalar) -> int:
    return int(np.frombuffer(packed.as_buffer(), np.int64, 1)[0])


def _numbers(table: pa.Table | pa.RecordBatch, name: str, kind: type) -> np.ndarray:
    """The numbers in a column of packed arrays, row after row; a null has none."""
    parts = [np.frombuffer(CODEC().decompress(x.as_buffer()[8:], _size(x)), kind) for x in table.column(name) if x.is_valid]
    return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, kind), *parts])


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different codes, sorted; a place of each; by place its number among them."""
    by = np.argsort(codes)
    ordered = codes[by]
    new = np.append(True, ordered[1:] != ordered[:-1])[: len(codes)]
    which = np.empty(len(codes), np.int64)
    which[by] = np.cumsum(new) - 1
    return ordered[new], by[new], which


def blocks(read: DataFrame) -> DataFrame:
    """The texts of ``read`` (doc_id, text) as numbers into the different words of their block. ``ids`` holds the
    numbers' lowest bytes first, which packs better."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        doc_ids, train, codes, sizes, held = [], [], [], [], 0

        def given() -> pa.RecordBatch:
            symbols, _, ids = _distinct(np.concatenate(codes))
            bounds = np.concatenate([[0], *sizes]).cumsum()
            return _batch(BLOCKS, {
                "block": [part << 32 | made], "doc_id": [[x for ids in doc_ids for x in ids]],
                "train": [_packed(np.concatenate(train))], "bounds": [_packed(bounds.astype(np.int64))],
                "symbols": [_packed(symbols)], "ids": [_packed(ids.astype(np.uint32).view(np.uint8).reshape(-1, 4).T)],
                "n_tokens": [len(ids)], "n_symbols": [len(symbols)],
            })

        for batch in batches:
            for words in word_chunks(batch.column(2)):
                found, bounds = tokens(words)
                rows = slice(words.first_row, words.first_row + len(bounds) - 1)
                doc_ids.append(batch.column(0)[rows].to_pylist())
                train.append(batch.column(1)[rows].to_numpy(zero_copy_only=False))
                codes.append(found)
                sizes.append(np.diff(bounds))
                held += len(words.raw)
                if held >= BLOCK_BYTES:
                    yield given()
                    made, held = made + 1, 0
                    for x in (doc_ids, train, codes, sizes):
                        x.clear()
        if codes:
            yield given()

    return read.select("doc_id", ~held_out("doc_id"), "text").mapInArrow(encode, BLOCKS)


class Block:
    """A row of BLOCKS: by token the number of its word, its text's row, and the number of orders whose context is a
    candidate (``level``) or hot; by word its code and count."""

    def __init__(self, row: pa.RecordBatch | pa.Table):
        self.block, self.doc_id = row.column("block")[0].as_py(), row.column("doc_id")[0]
        self.bounds, self.symbols = _numbers(row, "bounds", np.int64), _numbers(row, "symbols", np.uint64)
        self.ids = np.ascontiguousarray(_numbers(row, "ids", np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
        self.starts, self.end = self.bounds[:-1], np.searchsorted(self.symbols, END).astype(np.uint32)
        self.train = _numbers(row, "train", bool)
        self.rows = np.repeat(np.arange(len(self.starts), dtype=np.uint32), np.diff(self.bounds))
        self.counts, self.marks = _numbers(row, "counts", np.int64), _numbers(row, "marks", np.uint8)
        self.before = [self.ids]

    def previous(self, k: int) -> np.ndarray:
        """By token the number of the word k places before; what lies before a text are ends."""
        while len(self.before) <= k:
            found = np.concatenate(([self.end], self.before[-1][:-1]))
            found[self.starts] = self.end
            self.before.append(found)
        return self.before[k]

    def context(self, at: np.ndarray, order: int) -> np.ndarray:
        code = self.symbols[self.previous(order)[at]]
        for k in range(order - 1, 0, -1):
            code = _after(code, self.symbols[self.previous(k)[at]])
        return code

    def asking(self, at: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the tokens ``at``: the entries and contexts of an order, and whether the context is hot."""
        context = self.context(at, order)
        return _after(context, self.symbols[self.ids[at]]), context, self.marks[at] >> 4 >= order


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block(batch.slice(i, 1))


class Asked:
    """The different entries of some tokens of a block, dealt to ``groups`` by context, by entry if it is hot; an answer for each
    comes back in that order."""

    def __init__(self, entry: np.ndarray, context: np.ndarray, hot: np.ndarray, groups: int):
        self.entry, self.first, self.inverse = _distinct(entry)
        key = np.where(hot[self.first], self.entry, context[self.first])
        to = ((key >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
        self.order = np.argsort(to, kind="stable")
        self.to, self.starts = np.unique(to[self.order], return_index=True)

    def questions(self, block: int, times: np.ndarray, context: np.ndarray | None = None, before: np.ndarray | None = None) -> pa.RecordBatch:
        """``times``, ``context`` and ``before`` by token; an entry's times are summed."""
        summed = np.bincount(self.inverse, times, len(self.entry)).astype(np.uint32)
        columns = {"entry": self.entry, "times": summed}
        if context is not None:
            columns |= {"context": context[self.first], "before": before[self.first]}
        packed = {k: [_packed(x) for x in np.split(c[self.order], self.starts[1:])] if len(self.to) else [] for k, c in columns.items()}
        return _batch(QUESTIONS, {"to": self.to, "block": [block] * len(self.to), **packed})

    def by_token(self, answers: np.ndarray) -> np.ndarray:
        found = np.empty_like(answers)
        found[self.order] = answers
        return found[self.inverse]


def _answers(replies: pa.Table, level: int, kind: type) -> np.ndarray:
    """A block's answers of one level, in the order asked."""
    mine = replies.filter(pc.equal(replies.column("level"), level))
    return _numbers(mine.take(pc.sort_indices(mine.column("to"))), "answer", kind)


def _counter(level: int) -> Callable[[pa.Table], pa.Table]:
    """Answers a group's questions with the entries' counts; a row without block has N and V of the group."""

    def count(asked: pa.Table) -> pa.Table:
        entry, times = _numbers(asked, "entry", np.uint64), _numbers(asked, "times", np.uint32)
        different, _, which = _distinct(entry)
        n = np.bincount(which, times, len(different)).astype(np.int64)
        return _replied(asked, level, n[which], int(n.sum()), int((n > 0).sum()))

    return count


def _replied(asked: pa.Table, level: int, answers: np.ndarray, n: int = 0, v: int = 0) -> pa.Table:
    sizes = [_size(x) // 8 for x in asked.column("entry")]
    packed = [_packed(x) for x in np.split(answers, np.cumsum(sizes)[:-1])]
    rows = len(packed) + 1
    return pa.Table.from_batches([_batch(ANSWERS, {
        "block": [*asked.column("block").to_pylist(), None], "level": [level] * rows, "to": [*asked.column("to").to_pylist(), None],
        "answer": [*packed, None], "n": [0] * len(packed) + [n], "v": [0] * len(packed) + [v],
    })])


def _states(asked: pa.Table) -> tuple[np.ndarray, ...]:
    """By entry asked, its number among the different ones; by different entry its count, parent's probability and context's
    number; by context its code, total, different symbols and sum of n * ln(n / parent)."""
    context, entry = _numbers(asked, "context", np.uint64), _numbers(asked, "entry", np.uint64)
    before, times = _numbers(asked, "before", np.float64), _numbers(asked, "times", np.uint32)
    _, first, which = _distinct(entry)
    n, before = np.bincount(which, times, len(first)), before[first]
    contexts, _, state = _distinct(context[first])
    sums = [np.bincount(state, x, len(contexts)) for x in (n, n > 0, n * np.log(np.maximum(n, 1) / before))]
    return which, n, before, state, contexts, *sums


def _partial(asked: pa.Table) -> pa.Table:
    *_, contexts, total, m, gain = _states(asked)
    columns = {"context": contexts.view(np.int64), "total": total.astype(np.int64), "m": m.astype(np.int64), "gain": gain}
    return pa.Table.from_batches([_batch(STATES, columns)])


def _learner(level: int, n: int, min_count: int, hot: tuple[np.ndarray, ...]) -> Callable[[pa.Table], pa.Table]:
    """Answers a group's questions with smoothed probabilities. ``hot``: sorted contexts that lie in many groups, and their sums."""

    def learn(asked: pa.Table) -> pa.Table:
        which, counts, before, state, contexts, total, m, gain = _states(asked)
        if len(hot[0]):
            at = np.minimum(np.searchsorted(hot[0], contexts), len(hot[0]) - 1)
            shared = hot[0][at] == contexts
            total, m, gain = (np.where(shared, whole[at], own) for whole, own in zip(hot[1:], (total, m, gain), strict=True))
        retained = (total >= min_count) & (gain - total * np.log(np.maximum(total, 1)) > 0.5 * m * np.log(max(n, 2)))
        p = np.where(retained[state], (counts + m[state] * before) / (total + m)[state], before)
        return _replied(asked, level, p[which])

    return learn


class Learning:
    """What the tasks know of the corpus: N, V, the settings, the number of groups and the highest order of a hot context."""

    def __init__(self, n: int, v: int, groups: int, settings: Settings, hottest: int = 0):
        self.n, self.v, self.groups, self.settings, self.hottest = n, v, groups, settings, hottest

    def probabilities(self, block: Block, part: int, replies: pa.Table | None, order: int) -> tuple[np.ndarray, np.ndarray]:
        """The places of a part's tokens and their probabilities by the orders up to ``order``, whose answers ``replies`` has."""
        inside = np.flatnonzero((block.symbols % np.uint64(PARTS) == part)[block.previous(1)])
        p = ((block.counts + 1) / float(self.n + self.v + 1))[block.ids[inside]]
        for k in range(1, order + 1):
            mine = np.flatnonzero(block.marks[inside] & 15 >= k)
            p[mine] = Asked(*block.asking(inside[mine], k), self.groups).by_token(_answers(replies, k, np.float64))
        return inside, p

    def ask(self, block: Block, part: int, replies: pa.Table | None, order: int, hot_only: bool) -> pa.RecordBatch:
        inside, p = self.probabilities(block, part, replies, order - 1)
        marks = block.marks[inside]
        mine = np.flatnonzero((marks >> 4 if hot_only else marks & 15) >= order)
        entry, context, hot = block.asking(inside[mine], order)
        return Asked(entry, context, hot, self.groups).questions(block.block, block.train[block.rows[inside[mine]]], context, p[mine])


def _marked(block: Block, seen: np.ndarray, order: int, settings: Settings) -> np.ndarray:
    """The marks with those of an order, from the counts of the entries one order down, by token."""
    total = np.concatenate(([0], seen[:-1]))
    total[block.starts] = block.counts[block.end]
    level, hot = block.marks & 15, block.marks >> 4
    level = np.where((level == order - 1) & (total >= settings.min_count), order, level)
    return (level + 16 * np.where((hot == order - 1) & (total >= HOT), order, hot)).astype(np.uint8)


def _with(row: pa.Table, marks: np.ndarray, **columns: np.ndarray) -> pa.Table:
    """The block's row with its marks, the highest order of a hot context in it and other columns put in."""
    columns = {k: pa.array([_packed(x)], pa.binary()) for k, x in (columns | {"marks": marks}).items()}
    for name, values in (columns | {"hottest": pa.array([int((marks >> 4).max())], pa.int32())}).items():
        row = row.set_column(row.schema.get_field_index(name), name, values)
    return row


def _back(made: DataFrame, answers: DataFrame, use: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``use`` on each block's row and its answers."""
    mine = answers.where(F.col("block").isNotNull())
    return made.groupBy("block").cogroup(mine.groupBy("block")).applyInArrow(use, schema)


def learn(read: DataFrame, settings: Settings = Settings()) -> tuple[Learning, DataFrame]:
    """What all parts share, and the stored blocks of the texts ``read`` (doc_id, text) with counts and marks."""
    if settings.max_order > 15:
        raise ValueError("max_order is 15 at most: a token's marks hold four bits for it")
    made = stored(blocks(read), "blocks")
    size, different = made.agg(F.sum("n_tokens"), F.sum("n_symbols")).first()
    groups = 1 + (different or 0) // GROUP

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _each(batches):
            yield Asked(block.symbols, block.symbols, np.zeros(len(block.symbols), bool), groups).questions(
                block.block, np.bincount(block.ids, block.train[block.rows], len(block.symbols)))

    counts = stored(made.mapInArrow(ask_words, QUESTIONS).groupBy("to").applyInArrow(_counter(0), ANSWERS), "word_counts")
    n, v = counts.agg(F.sum("n"), F.sum("v")).first()
    known = Learning(n or 0, v or 0, 1 + (size or 0) // GROUP // PARTS, settings)

    def put_counts(row: pa.Table, replies: pa.Table) -> pa.Table:
        block = Block(row)
        symbols = Asked(block.symbols, block.symbols, np.zeros(len(block.symbols), bool), groups)
        block.counts = symbols.by_token(_answers(replies, 0, np.int64))
        block.marks = np.zeros(len(block.ids), np.uint8)
        return _with(row, counts=block.counts, marks=_marked(block, block.counts[block.ids], 1, settings))

    bare, made = made, stored(_back(made, counts, put_counts, BLOCKS), "blocks")
    release(bare, counts)
    for order in range(2, settings.max_order + 1):
        made = _mark(made, order, known.groups * PARTS, settings)
    known.hottest = made.agg(F.max("hottest")).first()[0] or 0
    return known, made


def _mark(made: DataFrame, order: int, groups: int, settings: Settings) -> DataFrame:
    """The blocks with the marks of an order from 2."""

    def asked(block: Block) -> tuple[np.ndarray, Asked]:
        mine = np.flatnonzero(block.marks & 15 >= order - 1)
        entry = block.asking(mine, order - 1)[0]
        return mine, Asked(entry, entry, np.zeros(len(mine), bool), groups)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _each(batches):
            mine, entries = asked(block)
            yield entries.questions(block.block, block.train[block.rows[mine]])

    def put_marks(row: pa.Table, replies: pa.Table) -> pa.Table:
        block = Block(row)
        mine, entries = asked(block)
        seen = np.zeros(len(block.ids), np.int64)
        seen[mine] = entries.by_token(_answers(replies, order, np.int64))
        return _with(row, marks=_marked(block, seen, order, settings))

    counts = stored(made.mapInArrow(ask, QUESTIONS).groupBy("to").applyInArrow(_counter(order), ANSWERS), "entry_counts")
    marked = stored(_back(made, counts, put_marks, BLOCKS), "blocks")
    release(made, counts)
    return marked


def learn_part(known: Learning, made: DataFrame, part: int) -> list[DataFrame]:
    """By order, the stored answers to what the blocks ask about the tokens after the words of a part."""
    levels: list[DataFrame] = []
    for order in range(1, known.settings.max_order + 1):

        def questions(hot_only: bool, order: int = order, below: tuple = tuple(levels)) -> DataFrame:
            if not below:
                return made.mapInArrow(lambda batches: (known.ask(b, part, None, order, hot_only) for b in _each(batches)), QUESTIONS)
            ask = lambda row, replies: pa.Table.from_batches([known.ask(Block(row), part, replies, order, hot_only)])
            return _back(made, reduce(DataFrame.unionAll, below), ask, QUESTIONS)

        hot = _hot_states(questions(True)) if order <= known.hottest else (np.zeros(0, np.uint64),) * 4
        learned = _learner(order, known.n, known.settings.min_count, hot)
        levels.append(stored(questions(False).groupBy("to").applyInArrow(learned, ANSWERS), "answers"))
    return levels


def _hot_states(asked: DataFrame) -> tuple[np.ndarray, ...]:
    """The sums of contexts that lie in many groups: N / HOT of them an order at most."""
    sums = asked.groupBy("to").applyInArrow(_partial, STATES).groupBy("context").agg(*[F.sum(c).alias(c) for c in ("total", "m", "gain")])
    table = sums.toArrow()
    context = table.column("context").to_numpy().view(np.uint64)
    by = np.argsort(context)
    return context[by], *(table.column(c).to_numpy()[by] for c in ("total", "m", "gain"))


@cleaned
def score_texts(docs: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id",
                text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row."""
    read = small_batches(docs).select(F.col(id_column).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    known, made = learn(read, settings)

    def of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _each(batches):
            counts, rows = block.counts[block.ids], len(block.starts)
            p = np.log10((counts + 1) / float(known.n + known.v + 1))
            yield _batch(ROWS, {
                "block": [block.block] * rows, "row": np.arange(rows), "doc_id": block.doc_id.values, "n_tokens": np.diff(block.bounds),
                "n_known": np.add.reduceat((counts > 0).astype(np.int64), block.starts), "base_score": np.add.reduceat(p, block.starts),
            })

    words = stored(made.mapInArrow(of_words, ROWS), "words")
    def of_part(part: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
        def score(row: pa.Table, replies: pa.Table) -> pa.Table:
            block = Block(row)
            inside, p = known.probabilities(block, part, replies, settings.max_order)
            total = np.bincount(block.rows[inside], np.log10(p), len(block.starts))
            columns = {"block": [block.block] * len(total), "row": np.arange(len(total)), "score": total}
            return pa.Table.from_batches([_batch(SCORES, columns)])

        return score

    sums = []
    for part in range(PARTS):
        levels = learn_part(known, made, part)
        sums.append(stored(_back(made, reduce(DataFrame.unionAll, levels), of_part(part), SCORES), "sums"))
        release(*levels)
    release(made)
    scores = reduce(DataFrame.unionAll, sums).groupBy("block", "row").agg(F.sum("score").alias("score"))
    return words.join(growing(scores), ["block", "row"]).select(
        "doc_id", held_out("doc_id").alias("held_out"), "n_tokens", "n_known", F.lit(known.n).cast("bigint").alias("train_tokens"),
        "base_score", "score",
    )
