import collections
import math
import zlib

import numpy as np
import pytest

import brute
from barflow.llm import common, suffixtree
from barflow.llm.queries import QUERIES


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


@pytest.fixture(scope="module")
def scored(spark):
    return {r["doc_id"]: r for r in QUERIES["op7_suffix_tree_scores"](spark, "/root/testdata/sf0.01").collect()}


def test_counts_and_base(scored):
    docs = brute.documents("/root/testdata/sf0.01")
    counts = collections.Counter()
    for i, t in docs:
        if not held(i):
            counts.update([*brute.words(t), "END"])
    n, v = sum(counts.values()), len(counts)
    for i, t in docs:
        w, row = [*brute.words(t), "END"], scored[i]
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        known = sum(counts[x] > 0 for x in w)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["held_out"]) == (len(w), known, n, held(i))
        assert abs(row["base_score"] - base) < 1e-9 * abs(base)


def test_held_out_texts_score_better_than_the_base(scored):
    rows = [r for r in scored.values() if r["held_out"]]
    gain = sum(r["score"] - r["base_score"] for r in rows) / sum(r["n_tokens"] for r in rows)
    assert len(rows) > 100 and gain > 0.05


@pytest.fixture(scope="module")
def small(spark):
    texts = ["a b a b a b c", "a b c a b d", "c d c d x y", "a b a b"] * 50
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return suffixtree.fit(df, suffixtree.Settings(min_share=0.02, count_share=0.001))[0]


def test_distributions_sum_to_one(small):
    ids = np.arange(len(small.root))
    assert abs(small.root.sum() - 1) < 1e-9 and any(o.retained.any() for o in small.orders)
    for order, n in enumerate(map(lambda o: len(o.keys), small.orders), 1):
        for context in range(n):
            chain, at = [np.full(len(ids), context)], context
            for k in range(order - 1, 0, -1):
                at = small.orders[k].parent[at]
                chain.insert(0, np.full(len(ids), at))
            assert abs(small.probability(chain, ids).sum() - 1) < 1e-6


def test_long_texts_known_order_is_likelier(spark):
    train = [(i, "red green blue " * 20) for i in range(40)]
    rows = train + [(100, "red green blue red green blue"), (101, "blue green red blue green red")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in suffixtree.score_texts(df, suffixtree.Settings(min_share=0.01)).collect()}
    assert got[100]["score"] > got[101]["score"] + 3 and abs(got[100]["base_score"] - got[101]["base_score"]) < 1e-6


def test_edges(spark):
    df = brute.edge_table(spark, "n", "word")
    rows = suffixtree.score_texts(df).collect()
    assert len(rows) == len(brute.EDGE_ROWS)
    assert sorted(r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 7)) == [1, 1, 1]
    assert len({r["score"] for r in rows if r["doc_id"] == 3}) == 1
    assert sum(r["doc_id"] is None for r in rows) == 1
    assert suffixtree.score_texts(brute.empty_table(spark)).count() == 0
    only = spark.createDataFrame([(i, "never seen") for i in range(60) if held(i)], "doc_id long, text string")
    alone = suffixtree.score_texts(only).collect()
    assert alone and all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 for r in alone)


def plain_scores(docs, min_count):
    """Scores by the whole tree of order 2, with dictionaries."""
    train, counts = [], [collections.defaultdict(collections.Counter) for _ in range(3)]
    grams = lambda t: zip(["END", "END", *brute.words(t)], ["END", *brute.words(t)], [*brute.words(t), "END"])
    for i, t in docs:
        if not held(i):
            train += list(grams(t))
    for a, b, w in train:
        for k, context in enumerate([(), (b,), (a, b)]):
            counts[k][context][w] += 1
    n, v = len(train), len(counts[0][()])
    retained = {}

    def p(context, w):
        if not context:
            return (counts[0][()][w] + 1) / (n + v + 1)
        after, before = counts[len(context)].get(context, {}), p(context[1:], w)
        c, m = sum(after.values()), len(after)
        if c < min_count:
            return before
        if context not in retained:
            gain = sum(x * math.log(x / c / p(context[1:], y)) for y, x in after.items())
            retained[context] = gain > 0.5 * m * math.log(n)
        return (after.get(w, 0) + m * before) / (c + m) if retained[context] else before

    scores = {i: sum(math.log10(p((a, b), w)) for a, b, w in grams(t)) for i, t in docs}
    return scores, sum(retained.values())


def test_scores_are_those_of_the_whole_tree(scored):
    want, states = plain_scores(brute.documents("/root/testdata/sf0.01"), 5)
    assert states > 300
    for i, score in want.items():
        assert abs(scored[i]["score"] - score) < 1e-8 * abs(score), i


def test_rare_contexts_are_learned_whatever_the_share(spark):
    # 15 of 200,000 tokens: no symbols of the bounded model
    filler = [(i, " ".join(f"w{i}x{k}" for k in range(1000))) for i in range(200)]
    rows = filler + [(1000 + i, "alpha beta gamma " * 3) for i in range(5)] + [(2000, "alpha beta gamma"), (2001, "beta alpha gamma")]
    got = {r["doc_id"]: r for r in suffixtree.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2000]["score"] > got[2001]["score"] + 2


def test_parts_hold_all_tokens_once_and_leave_only_sums(spark):
    """Each part has a share of the entries; their tables are gone when the result is read."""
    df = common.table(spark, "/root/testdata/sf0.001", "documents")
    read = df.select("doc_id", "text")
    parts = [suffixtree._count_entries(read, [], part) for part in range(suffixtree.PARTS)]
    counts = [{r["entry"]: r["n"] for r in part.collect()} for part in parts]
    whole = {r["entry"]: r["n"] for r in suffixtree._count_contexts(read, []).collect()}
    assert {k: n for part in counts for k, n in part.items()} == whole and sum(map(len, counts)) == len(whole)
    assert max(map(len, counts)) < 0.5 * len(whole)
    with common.tables() as held:
        assert suffixtree.score_texts(df).count() == df.count()
    left = [common._PATHS[t].rpartition("/")[2].rpartition("-")[0] for t in held if t in common._PATHS]
    assert sorted(left) == ["sums"] * suffixtree.PARTS + ["words"]
    common.release(*held)


def test_frequent_contexts_are_dealt_over_all_groups(spark, monkeypatch):
    """Many small blocks and groups, most contexts hot: the scores stay those of the whole tree."""
    for name, value in (("BLOCK_BYTES", 1 << 14), ("GROUP", 1 << 13), ("HOT", 8), ("PARTS", 2)):
        monkeypatch.setattr(suffixtree, name, value)
    docs = brute.documents("/root/testdata/sf0.001")
    known, made = suffixtree.learn(spark.createDataFrame(docs, "doc_id long, text string"))
    assert made.count() > 2 and known.groups > 1 and known.hottest == 2
    got = {r["doc_id"]: r["score"] for r in suffixtree.score_texts(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, score in plain_scores(docs, 5)[0].items():
        assert abs(got[i] - score) < 1e-8 * abs(score), i


def test_no_row_moves_for_each_token(spark, monkeypatch):
    """What is dealt to learn a part: one row for a block and group (one for every token before)."""
    df = common.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    known, made = suffixtree.learn(df)
    moved, plain = [], suffixtree.stored
    monkeypatch.setattr(suffixtree, "stored", lambda answers, name: moved.append(plain(answers, name)) or moved[-1])
    suffixtree.learn_part(known, made, 0)
    assert len(moved) == 2 and made.agg({"n_tokens": "sum"}).first()[0] > 100_000
    assert all(m.count() <= made.count() * known.groups + known.groups for m in moved)


def test_too_long_contexts_are_an_error(spark):
    with pytest.raises(ValueError, match="max_order"):
        suffixtree.score_texts(brute.empty_table(spark), suffixtree.Settings(max_order=16))
