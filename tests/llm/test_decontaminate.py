import random
import re

import pyarrow as pa

import brute
from barflow.llm import decontaminate
from barflow.llm.queries import QUERIES

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"


def plain_words(text):
    return [w.decode() for w in re.findall(rb"[0-9a-z\x80-\xff]+".replace(b"a-z", b"A-Za-z"), (text or "").encode())]


def test_tiling_equals_the_plain_greedy_loop():
    rng = random.Random(8)
    for _ in range(300):
        item = [rng.choice("abcd") for _ in range(rng.randrange(3, 14))]
        text = [rng.choice("abcd") for _ in range(rng.randrange(3, 30))]
        index = decontaminate.Index.of([(1, " ".join(item))], 3)
        words = next(decontaminate.word_chunks(pa.array([" ".join(text)]), decontaminate.WORD_BYTES))
        codes, _ = decontaminate.shingles(words, 3)
        pairs = [(p, j) for j, c in enumerate(codes) for x, p in zip(index.codes, index.places) if x == c]
        covered = 0
        if pairs:
            import numpy as np

            i, j = np.array(pairs).T
            covered = sum(n for _, _, n in decontaminate.tile(i, j, 3))
        assert covered == brute.tiling_coverage(text, item, 3), (item, text)


def test_query_finds_the_passages(spark):
    import duckdb

    items = duckdb.sql(f"SELECT item_id, text FROM '{brute.SF}/benchmark.parquet'").fetchall()
    got = {r["doc_id"]: r for r in QUERIES["op10_decontamination"](spark, brute.SF).collect()}
    texts = {i: " " + " ".join(w.lower() for w in plain_words(t)) + " " for i, t in brute.documents()}
    holding = {i for i, t in texts.items() for _, b in items if " " + " ".join(w.lower() for w in plain_words(b)) + " " in t}
    assert holding and holding <= {i for i, r in got.items() if r["contaminated"]}
    assert len(got) == len(texts) and sum(r["contaminated"] for r in got.values()) <= len(holding) + 2


def test_reordered_passages_and_blocks(spark):
    w = ITEM.split()
    rows = [
        (1, f"x y {ITEM.upper()}!! q"), (2, " ".join(w[8:] + ["foo"] * 30 + w[:8])), (3, " ".join(w[:6])),
        (4, f"{ITEM} {ITEM}"), (5, " ".join(w[:5] + ["no"] + w[5:10])),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, ITEM), (2, ITEM), (3, None), (4, "too short"), (None, "")], "item_id long, text string")
    for block_bytes in (decontaminate.BLOCK_BYTES, 60):
        got = {r["doc_id"]: r for r in decontaminate.contamination(docs, bench, block_bytes=block_bytes).collect()}
        assert [got[i]["contaminated"] for i in (1, 2, 3, 4, 5)] == [True, True, False, True, True]
        assert got[1]["n_items"] == 2 and got[1]["item_id"] == 1 and got[2]["coverage"] == 1.0
        assert abs(got[5]["coverage"] - 10 / 15) < 1e-9


def test_edges(spark):
    df = brute.edge_table(spark, "matches", "item_id")
    bench = spark.createDataFrame([(9, brute.PROSE)], "item_id long, text string")
    kept = decontaminate.keep_clean(df, bench)
    assert kept.columns == df.columns
    assert sorted(r["item_id"] or 0 for r in kept.collect()) == [0, 1, 2, 7, 8, 9]
    assert decontaminate.keep_clean(df, bench.limit(0)).count() == len(brute.EDGE_ROWS)
    assert decontaminate.keep_clean(brute.empty_table(spark), bench).count() == 0
