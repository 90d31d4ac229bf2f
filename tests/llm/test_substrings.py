import collections
import random

import pytest

import brute
from barflow.llm import substrings


def result(df, **settings):
    rows = substrings.remove_repeats(df, **settings).collect()
    return sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows)


def test_expansion_finds_repeated_windows():
    rng = random.Random(1)
    for _ in range(200):
        length = rng.choice([3, 5, 12])
        texts = ["".join(rng.choice("ab") for _ in range(rng.randint(30, 60))).encode() for _ in range(3)]
        pieces = set()
        for _ in range(6):
            text, start = rng.choice(texts), rng.randint(0, 8)
            pieces.add(text[start : start + rng.randint(length, 20)])
        pieces = [p for p in pieces if len(p) >= length]
        counts = collections.Counter(p[i : i + length] for p in pieces for i in range(len(p) - length + 1))
        for piece, flags in zip(pieces, substrings.repeated_starts(pieces, length), strict=True):
            assert list(flags) == [counts[piece[i : i + length]] > 1 for i in range(len(piece) - length + 1)]


@pytest.mark.parametrize("group_bytes", [substrings.GROUP_BYTES, 1000])
def test_matches_brute_force(spark, group_bytes):
    docs = brute.documents()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = sorted((True, i, *rest) for i, rest in brute.repeated_bytes(docs, 400).items())
    assert result(df, group_bytes=group_bytes) == want


def test_short_length_within_and_across_texts(spark):
    docs = [(1, "abcabcabcabc"), (2, "xxabcabyy"), (3, "é" * 7), (4, "unlike"), (5, "unlike"), (6, "éxé")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert result(df, length=5) == sorted((True, i, *rest) for i, rest in brute.repeated_bytes(docs, 5).items())


def test_edges(spark):
    df = brute.edge_table(spark, "n_bytes", "key_a")
    rows = [(n, t) for n, (_, t, _, _) in enumerate(brute.EDGE_ROWS)]
    want = brute.repeated_bytes([(n, t) for n, t in rows if t != brute.LONG], 50)
    got = result(df, length=50)
    assert len(got) == len(rows)
    gone = brute.repeated_bytes([(0, brute.PROSE), (1, brute.PROSE)], 50)[0]
    assert [g[2:] for g in got if g[:2] == (True, 3)] == [gone, gone] == [want[2], want[3]]
    assert [g[2:] for g in got if not g[0]] == [gone]
    assert [g[2:5] for g in got if g[1] in (1, 2) and g[0]] == [(0, 0, 0)] * 2
    assert substrings.remove_repeats(brute.empty_table(spark)).count() == 0


@pytest.mark.parametrize("group_bytes", [substrings.GROUP_BYTES, 1000])
def test_periodic_texts(spark, group_bytes):
    rng = random.Random(2)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = noise(90)
    docs = [
        (1, "-" * 3000), (2, noise(500) + "=" * 450), (3, noise(300) + "0123456789" * 200 + noise(300)), (4, "0123456789" * 41),
        (5, noise(100) + shared + noise(100)), (6, noise(400) + "~" * 100), (7, shared + "-" * 401),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for length in (60, 400):
        want = sorted((True, i, *rest) for i, rest in brute.repeated_bytes(docs, length).items())
        assert result(df, length=length, group_bytes=group_bytes) == want


def test_periods_are_one_fragment():
    import numpy as np

    for period in (b"x", b"0123456789", b"-" * 79 + b"\n"):
        data = np.frombuffer(period * (200_000 // len(period)), dtype=np.uint8)
        first, last, _, places = substrings.picks(data, 400)
        assert len(first) == 1 and last[0] == len(data) - 400 and places[0] > 1


def test_stored_tables_left(spark):
    """Only what the result reads is left: the facts and the removals."""
    import os

    from barflow.session import scratch_path

    folder = os.path.dirname(scratch_path(spark, "probe")).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    df = spark.createDataFrame(brute.documents(), "doc_id long, text string")
    out = substrings.remove_repeats(df)
    assert len(set(os.listdir(folder)) - before) <= 2
    assert out.count() == df.count()


def test_spans_give_the_counts_and_the_rest(spark):
    """The digests are those of the spans, the spans those of brute force; copies go whole, rows without a repeat have none."""
    import hashlib

    docs = [*brute.documents(), (900, None), (901, ""), (902, "z" * 399), (903, "ü" * 300), (904, "ü" * 300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want, texts = brute.repeated_bytes(docs, 400), {i: (t or "").encode() for i, t in docs}
    rows = substrings.remove_repeats(df).collect()
    assert len(rows) == len(docs) and any(len(r["spans"]) > 1 for r in rows)
    for row in rows:
        data, left, end = texts[row["doc_id"]], b"", 0
        for span in row["spans"]:
            assert span["length"] >= 400 and span["start"] >= end + bool(end)  # ascending and apart
            left += data[end : span["start"]]
            end = span["start"] + span["length"]
        left += data[end:]
        assert (len(data), len(data) - len(left), len(row["spans"]), hashlib.sha256(left).hexdigest()) == want[row["doc_id"]]
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in rows}
    assert [spans[i] for i in range(900, 905)] == [[], [], [], [(0, 600)], [(0, 600)]]


def test_planted_passages_are_caught(spark):
    """Passages of over 50 words in two documents each: those of 400 bytes or more go with every byte, shorter ones stay
    by the contract, and documents without one are left alone."""
    rng = random.Random(4)
    words = lambda n, size: " ".join("".join(rng.choice("abcdefghiéß") for _ in range(size)) for _ in range(n))
    docs, planted = [], {}
    for k in range(40):
        passage = words(rng.randint(51, 90), rng.choice((3, 6, 9)))
        for _ in range(2):
            before = words(rng.randint(0, 60), 5)
            planted[len(docs)] = len(before.encode()), passage.encode()
            docs.append((len(docs), before + passage + words(rng.randint(0, 60), 5)))
    docs += [(len(docs) + i, words(rng.randint(1, 300), 5)) for i in range(40)]
    rows = substrings.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    spans = {r["doc_id"]: [(s["start"], s["start"] + s["length"]) for s in r["spans"]] for r in rows}
    long = {i: (at, at + len(p)) for i, (at, p) in planted.items() if len(p) >= 400}
    caught = [any(a <= at and end <= b for a, b in spans[i]) for i, (at, end) in long.items()]
    others = [i for i, _ in docs if i not in long]
    alone = [r["n_removed"] == 0 for r in rows if r["doc_id"] not in long]
    print(f"planted passages of 400 bytes or more caught {sum(caught) / len(caught):.2f}, others left alone {sum(alone) / len(alone):.2f}")
    assert 20 <= len(caught) < len(planted) and len(alone) == len(others)
    assert all(caught) and all(alone)
