import collections
import hashlib

import numpy as np
import pytest

import brute
import public_tokenizers
from barflow.llm import alignment
from barflow.llm.queries import QUERIES, token_ranks

MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: What is easy to cut wrongly: runs of blanks, line ends beside blanks, marks of either vocabulary, many scripts.
ODD = [
    "a  b", " a", "a ", " ", "  ", "a\n b", "a \n b", "x \t b\n\n c", "<|endoftext|> and <s> </s> <unk> <0x41>", "naïve café — déjà vu",
    "日本語のテキスト と English", "🙂🙃 emoji🙂", "tab\tand\x0bvertical", "é combining ́x", "nul \x00 byte", "it's we'll I'VE",
    "no break 　wide", "numbers 1234567 3.14159", "a" * 3000, "▁ marker", "x▁y", "\x1c sep \x85 next", "'quoted' \"double\"  end  ",
]


@pytest.fixture(scope="module")
def tokenizers_pair():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=MODEL)


def byte_of_char():
    """Characters of byte-level entries and the bytes they stand for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


CHARS = byte_of_char()


def plain_tokens(pair, text):
    """(id, start, end) of both sides, or nothing if a side's bytes differ from the text's."""
    a, b = pair
    if not text:
        return [], []
    whole = (" " + text).encode()
    sides = []
    entries = [(i, bytes(CHARS[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    pieces = [(i, b.id_to_piece(i)) for i in b.encode(text)]
    made = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces]
    for tokens in (entries, made):
        if b"".join(t for _, t in tokens) != whole:
            return [], []
        at, out = 0, []
        for i, t in tokens:
            out.append((i, at, at + len(t)))
            at += len(t)
        sides.append(out)
    return sides


def plain_rows(pair, rows):
    aligned = []
    for doc_id, text in rows:
        a, b = plain_tokens(pair, text)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append(tuple(",".join(str(i) for i, s, e in side if low <= s and e <= cut) for side in (a, b)))
            low = cut
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        aligned.append((doc_id, len(a), len(b), groups, links))
    count = collections.Counter(link for *_, links in aligned for link in set(links))
    best = collections.defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return sorted(
        (
            doc_id, n_a, n_b, len(groups), len(links), sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links),
            hashlib.sha256(";".join(f"{x}|{y}" for x, y in groups).encode()).hexdigest() if n_a else "",
        )
        for doc_id, n_a, n_b, groups, links in aligned
    )


def aligned(df, **options):
    got = alignment.align(df, *token_ranks(), MODEL, 32_000, **options)
    return sorted(tuple(r) for r in got.collect())


def test_odd_texts_equal_plain_loops(spark, tokenizers_pair):
    rows = [(i, text) for i, text in enumerate([*ODD, None, "", *ODD[:3]])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_rows(tokenizers_pair, rows)
    assert aligned(df) == want
    assert aligned(df, head_pairs=5) == want and aligned(df, head_pairs=0) == want
    by_id = {row[0]: row for row in want}
    assert by_id[ODD.index("x▁y")][1:] == (0, 0, 0, 0, 0, 0, "") and by_id[0][1] > 0


def test_documents_equal_plain_loops(spark, tokenizers_pair):
    docs = [(i, t) for i, t in brute.documents() if len(t) < 2500]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert aligned(df, head_pairs=200) == plain_rows(tokenizers_pair, docs)


def test_query_and_edges(spark, tokenizers_pair):
    got = QUERIES["op11_tokenizer_alignment"](spark, brute.SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got.count() == len(brute.documents()) and got.where("n_a = 0 AND n_groups > 0").count() == 0
    edge = brute.edge_table(spark, "pairs", "row")
    rows = [(r["doc_id"], r["text"]) for r in edge.collect() if r["text"] is None or len(r["text"]) < 1000]
    short = edge.where("text IS NULL OR length(text) < 1000")
    got = alignment.align(short, *token_ranks(), MODEL, 32_000).collect()
    key = lambda row: tuple((x is None, x) for x in row)
    assert sorted(map(tuple, got), key=key) == [tuple(r) for r in sorted(plain_rows_any(tokenizers_pair, rows), key=key)]
    assert alignment.align(edge, *token_ranks(), MODEL, 32_000).count() == len(brute.EDGE_ROWS)
    assert aligned(brute.empty_table(spark)) == []


def plain_rows_any(pair, rows):
    """The same for rows whose ids may be null."""
    made = plain_rows(pair, [(i, text) for i, (_, text) in enumerate(rows)])
    return [(rows[row[0]][0], *row[1:]) for row in made]


def test_long_texts_are_put_together_from_chunks(monkeypatch):
    work = alignment.Aligner(*token_ranks(), MODEL)
    text = " ".join(f"word{i % 50} and  more\n {i}" for i in range(400))
    whole = work.text(text, work.cut(text))
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 300)
    monkeypatch.setattr(alignment, "CACHE_UNITS", 40)
    (cut,) = work.each([text])
    assert whole[:2] == cut[:2] and (whole[2] == cut[2]).all() and (whole[3] == cut[3]).all()


def test_coalescing_by_hand():
    got = alignment.coalesce(np.array([2, 3, 1, 2]), np.array([1, 4, 3]))
    assert got.a_group.tolist() == [0, 0, 1, 1] and got.b_group.tolist() == [0, 0, 1]
    assert list(zip(got.link_a.tolist(), got.link_b.tolist(), strict=True)) == [(0, 0), (0, 1), (1, 1), (2, 2), (3, 2)]
