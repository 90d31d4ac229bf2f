import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import brute
from barflow.llm import packing
from barflow.llm.queries import QUERIES, token_ranks

TRICKY = [
    "", " ", "  two  blanks ", "a\nb \n c", "tab\t tab", "don't  can't I'll", "12 345,678", "é ü 漢字   x", "end ",
    "\x1c x", "a <|endoftext|> b", "x y z",
]


def test_ids_equal_the_tokenizers_library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    ours = packing.tokenizer(*token_ranks())
    for text in TRICKY + [t for _, t in brute.documents()[:60]]:
        want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert ours.encode(text) == want, text


def test_added_token_inside_texts():
    """As the tokenizers library reads a text by default."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ours = packing.tokenizer(*token_ranks()).encode
    added = ["<|endoftext|>", "<|endoftext|> b<|endoftext|><|endoftext|>\n c ", "x<|endoftext|", "  <|endoftext|>  y"]
    for text in TRICKY + added:
        want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert packing.encode_added(ours, text) == want, text
    assert packing.encode_added(ours, "a <|endoftext|> b", None) == ours("a <|endoftext|> b")


def test_pieces_hold_the_added_token(spark):
    df = spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string")
    row = packing.document_pieces(df, *token_ranks()).first()
    ids = np.array([64, 220, 50256, 275, 0], dtype="<u4").tobytes()
    assert (row["length"], row["ids_crc32"]) == (5, zlib.crc32(ids))


def check_places(got, limit=1024):
    got = got.sort_values(["sequence_id", "offset"])
    before = got.groupby("sequence_id").length.cumsum() - got.length
    assert (before == got.offset).all()
    assert got.groupby("sequence_id").length.sum().max() <= limit


def test_all_documents_are_packed(spark):
    got = QUERIES["op6_packing"](spark, brute.SF).toPandas()
    check_places(got)
    ours = packing.tokenizer(*token_ranks())
    for doc_id, text in brute.documents():
        ids = ours.encode(text) + packing.END
        pieces = got[got.doc_id == doc_id].sort_values("start")
        assert (pieces.start == pieces.length.cumsum() - pieces.length).all()
        assert pieces.length.sum() == len(ids) // 4 == pieces.doc_tokens.iloc[0]
        for p in pieces.itertuples():
            assert p.ids_crc32 == zlib.crc32(ids[4 * p.start : 4 * (p.start + p.length)])
    used = got.length.sum() / (1024 * got.sequence_id.nunique())
    assert used > 0.95


def test_every_limit_holds():
    rng = np.random.default_rng(1)
    tokens = rng.integers(1, 200, 500)
    loss = (tokens * rng.random(500)).astype(int)
    limits = packing.Limits(tokens=256, segments=3, loss_tokens=100)
    sequence, offset = packing.fill(tokens, loss, limits)
    for s in np.unique(sequence):
        here = sequence == s
        assert here.sum() == 1 or (tokens[here].sum() <= 256 and here.sum() <= 3 and loss[here].sum() <= 100)
        order = np.argsort(offset[here])
        assert (np.cumsum(tokens[here][order]) - tokens[here][order] == offset[here][order]).all()
    bound = max(tokens.sum() / 256, 500 / 3, loss.sum() / 100)
    assert len(np.unique(sequence)) <= 1.25 * bound


def test_dot_product_prefers_what_fits_the_room():
    tokens, loss = np.array([80, 80, 20, 20]), np.array([5, 90, 90, 5])
    sequence, _ = packing.fill(tokens, loss, packing.Limits(100, 8, 100))
    assert len(set(sequence)) == 2


def test_edges(spark):
    df = brute.edge_table(spark, "length", "sequence_id")
    got = packing.pack_documents(df, *token_ranks()).toPandas()
    check_places(got)
    assert got.doc_tokens.min() == 1 and (got.start == 0).sum() == len(brute.EDGE_ROWS)
    assert packing.pack_documents(brute.empty_table(spark), *token_ranks()).count() == 0
