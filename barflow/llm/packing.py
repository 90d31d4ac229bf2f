"""Vector bin packing of token pieces into sequences under several limits at once.

Examples have a demand in three dimensions: tokens, segments (one each) and loss-bearing tokens. A
sequence is opened and filled with the example whose demand has the largest dot product with what
the sequence has left, each dimension weighted by the average demand, until none fits: the
dot-product heuristic of vector bin packing. Examples are dealt by hash into groups of about
``GROUP_ROWS`` rows, so each task packs a bounded number of small rows; texts and ids stay behind.

Documents are first cut into pieces of one full sequence and a rest, by ``document_pieces``.

Defined results: a null or empty text is the end token alone; repeated rows are packed one by one;
an example over a limit by itself gets a sequence of its own; ties go by size, then id; an empty
table gives an empty table; columns other than the named ones are dropped, so names cannot clash.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import small_batches, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GROUP_ROWS = 50_000
END = np.zeros(1, dtype="<u4").tobytes()
CACHE_WORDS = 500_000


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 64
    loss_tokens: int = 1024


class ByteTokenizer:
    """Ids of a byte-level vocabulary file of ranks (one base64 token and its id a line).

    The split pattern of these vocabularies always parts a text before a blank that is followed by
    something else than white space, so the ids of a blank and the word behind it are kept and
    looked up again. Other texts are encoded as a whole.
    """

    def __init__(self, ranks_path: str, pattern: str):
        import base64

        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        first, *rest = text.split(" ")
        known = self.known
        try:
            parts = [known[word] for word in rest]
        except KeyError:
            for word in rest:
                if word not in known:
                    if not word or word[0].isspace():
                        return self.whole(text)
                    if len(known) >= CACHE_WORDS:
                        known.clear()
                        return self.whole(text)
                    known[word] = self.whole(" " + word)
            parts = [known[word] for word in rest]
        return self.whole(first) + b"".join(parts)


#: Fixed value: the added token of the vocabulary and its id, which the tokenizer finds inside texts too.
ADDED = ("<|endoftext|>", 50256)


def encode_added(encode: Callable[[str], bytes], text: str, added: tuple[str, int] | None = ADDED) -> bytes:
    """Ids of a text in which the added token, wherever it stands, has its own id and parts what is around it."""
    if added is None or added[0] not in text:
        return encode(text)
    return np.array([added[1]], dtype="<u4").tobytes().join(encode(part) if part else b"" for part in text.split(added[0]))


TOKENIZERS: dict[str, ByteTokenizer] = {}


def tokenizer(ranks_path: str, pattern: str) -> ByteTokenizer:
    if ranks_path not in TOKENIZERS:
        TOKENIZERS[ranks_path] = ByteTokenizer(ranks_path, pattern)
    return TOKENIZERS[ranks_path]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long"


def document_pieces(docs: DataFrame, ranks_path: str, pattern: str, size: int = 1024,
                    id_column: str = "doc_id", text: str = "text", added: tuple[str, int] | None = ADDED) -> DataFrame:
    """Every document's ids and the end token 0, cut every ``size`` ids; all of them bear loss. ``added`` is a
    token that is recognised inside texts; with None its string is ordinary text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(ranks_path, pattern).encode
        for batch in batches:
            rows = []
            for doc_id, body in zip(batch.column(0), batch.column(1), strict=True):
                ids = encode_added(encode, body.as_py() or "", added) + END
                n = len(ids) // 4
                for start in range(0, n, size):
                    piece = ids[4 * start : 4 * (start + size)]
                    length = len(piece) // 4
                    rows.append((doc_id.as_py(), start, length, zlib.crc32(piece), n, length))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "loss_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], names=names)

    return small_batches(docs).select(F.col(id_column).cast("bigint"), F.col(text)).mapInArrow(cut, PIECES)


def fill(tokens: np.ndarray, loss: np.ndarray, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each example of one group."""
    n = len(tokens)
    sequence, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    capacity = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=np.float64)
    kinds, kind_of = np.unique(np.stack([tokens, loss], axis=1), axis=0, return_inverse=True)
    members = np.split(np.argsort(kind_of.ravel(), kind="stable"), np.cumsum(np.bincount(kind_of.ravel()))[:-1])
    left = np.array([len(m) for m in members])
    demand = np.column_stack([kinds[:, 0], np.ones(len(kinds)), kinds[:, 1]]) / capacity
    weight = (demand * left[:, None]).sum(axis=0) / max(n, 1)
    weighted = demand * weight
    at = 0

    def put(kind: int, start: int) -> None:
        nonlocal left
        left[kind] -= 1
        row = members[kind][left[kind]]
        sequence[row], offset[row] = at, start

    alone = np.flatnonzero((demand >= 1 - 1e-12).any(axis=1))  # nothing fits beside these
    for kind in alone:
        while left[kind]:
            put(kind, 0)
            at += 1
    open_kinds = np.flatnonzero(left)
    rest = int(left.sum())
    while rest:
        room, used = np.ones(3), 0
        live = open_kinds
        while True:
            live = live[(demand[live] <= room + 1e-12).all(axis=1) & (left[live] > 0)]
            if not len(live):
                break
            kind = live[np.argmax(weighted[live] @ room)]
            put(kind, used)
            used += int(kinds[kind, 0])
            room = room - demand[kind]
            rest -= 1
        at += 1
        if at % 64 == 0:
            open_kinds = open_kinds[left[open_kinds] > 0]
    return sequence, offset


def pack(examples: DataFrame, limits: Limits = Limits(), tokens: str = "length", loss: str = "loss_tokens",
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """The examples with sequence_id and the offset of their first token there."""
    held = stored(examples, "examples")
    groups = max(1, -(-held.count() // group_rows))
    number = F.xxhash64(*[F.col(c) for c in held.columns], F.monotonically_increasing_id())
    dealt = held.withColumn("pack_group", F.pmod(number, F.lit(groups)))
    order = held.columns

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order, kind="stable").reset_index(drop=True)
        sequence, offset = fill(frame[tokens].to_numpy(), frame[loss].to_numpy(), limits)
        base = int(frame["pack_group"].iloc[0]) << 32
        return frame[order].assign(sequence_id=base + sequence, offset=offset)

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema.fields)
    return dealt.groupBy("pack_group").applyInPandas(place, f"{shape}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, ranks_path: str, pattern: str, limits: Limits = Limits()) -> DataFrame:
    """Pieces of all documents with their places."""
    size = min(limits.tokens, limits.loss_tokens)
    return pack(document_pieces(docs, ranks_path, pattern, size), limits).drop("loss_tokens")
