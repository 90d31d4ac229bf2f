"""Plain versions of the operators for small tables, and rows at the edges."""

from __future__ import annotations

import collections
import hashlib

import duckdb

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977} and the {i}" for i in range(12_000))
PROSE = "The cat sat on the mat and the dog lay by the door while it was raining in the old town for a day."
#: Nulls, empty and long texts, repeated rows, a repeated id with another text; columns that clash.
EDGE_ROWS = [
    (1, None, "a", 1), (2, "", "a", 2), (3, PROSE, "a", 3), (3, PROSE, "a", 3), (4, PROSE, "b", 4),
    (None, PROSE, "b", 5), (5, LONG, None, None), (5, "another text with id five", None, 7), (6, "one two", "c", 8),
    (7, " \n\t ", "c", 9),
]


def edge_table(spark, *extra):
    """doc_id, text and two further columns, named ``extra``."""
    a, b = extra
    return spark.createDataFrame(EDGE_ROWS, f"doc_id long, text string, `{a}` string, `{b}` int")


def empty_table(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def documents(sf=SF):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()


def words(text):
    return (text or "").encode().lower().split()


def shingle_set(text, k):
    w = words(text)
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


class Forest:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def union(self, x, y):
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)


def near_duplicates(docs, k, percent):
    sets = {i: shingle_set(t, k) for i, t in docs}
    forest = Forest()
    by_shingle = collections.defaultdict(list)
    for i, s in sets.items():
        forest.find(i)
        for g in s:
            by_shingle[g].append(i)
    shared = collections.Counter(
        (a, b) for ids in by_shingle.values() for n, a in enumerate(ids) for b in ids[n + 1 :]
    )
    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            forest.union(a, b)
    return {i: (len(s), forest.find(i)) for i, s in sets.items()}


def repeated_bytes(docs, length):
    """doc → (bytes, removed, spans, hash of the rest)."""
    data = [(i, (t or "").encode()) for i, t in docs]
    counts = collections.Counter(d[p : p + length] for _, d in data for p in range(len(d) - length + 1))
    out = {}
    for i, d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - length + 1):
            if counts[d[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans = sum(g and (n == 0 or not gone[n - 1]) for n, g in enumerate(gone))
        left = bytes(x for x, g in zip(d, gone) if not g)
        out[i] = (len(d), sum(gone), spans, hashlib.sha256(left).hexdigest())
    return out


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        corner, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            corner, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, corner + (x != y))
    return row[-1]


def line_removals(docs, threshold, min_chars):
    """(doc, place) of the lines that are near an earlier line, links being followed."""
    places = collections.defaultdict(list)
    for i, t in docs:
        for place, line in enumerate((t or "").split("\n") if t else []):
            line = line.strip(" \t\n\x0b\x0c\r")
            if len(line) >= min_chars:
                places[line].append((i, place))
    forest = Forest()
    by_length = collections.defaultdict(list)
    for line in places:
        forest.find(line)
        by_length[len(line)].append((line, collections.Counter(line)))
    for length, lines in by_length.items():
        for line, letters in lines:
            for other_length in range(length, length + threshold + 1):
                for other, more in by_length.get(other_length, ()):
                    if other != line and (more - letters).total() <= threshold and edit_distance(line, other) <= threshold:
                        forest.union(line, other)
    classes = collections.defaultdict(list)
    for line, at in places.items():
        classes[forest.find(line)] += at
    return {place for at in classes.values() for place in set(at) - {min(at)}}


def tiling_coverage(text_words, item_words, min_match):
    """Words of the item covered by greedy string tiling, by the plain double loop."""
    used_text, used_item, covered = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for j in range(len(text_words)):
            for i in range(len(item_words)):
                n = 0
                while (
                    i + n < len(item_words) and j + n < len(text_words) and item_words[i + n] == text_words[j + n]
                    and i + n not in used_item and j + n not in used_text
                ):
                    n += 1
                if n > best[0]:
                    best = (n, j, i)
        n, j, i = best
        if n < min_match:
            return covered
        used_text.update(range(j, j + n))
        used_item.update(range(i, i + n))
        covered += n
