import collections
import random
import re
import time

import duckdb
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from barflow.llm import common
from barflow.llm.common import stored, table
from barflow.llm.packing import END, encode_added, tokenizer
from barflow.llm.queries import ORACLES, token_ranks


def test_stages_against_brute_force(spark):
    """Each stage is judged on what the one before it kept."""
    sf, stages = brute.SF, dict(corpus_pipeline.STAGES)
    docs = table(spark, sf, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, sf), name)
        kept[name] = out
        if name != "packing":
            assert out.columns == docs.columns and out.count() > 0
            docs = out
    assert list(stages) == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "packing"]
    rows = {name: [(r["doc_id"], r["text"]) for r in df.orderBy("doc_id").collect()] for name, df in kept.items() if name != "packing"}

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    verdicts = con.sql(ORACLES["op8_quality_rules"]).df().set_index("doc_id").kept
    assert {i for i, _ in rows["quality_rules"]} == set(verdicts[verdicts].index)

    gone = brute.line_removals(rows["quality_rules"], 2, 20)
    seen = set()
    for i, t in rows["quality_rules"]:
        for place, line in enumerate(t.split("\n")):
            line = line.strip(" \t\n\x0b\x0c\r")
            if 0 < len(line) < 20 and line in seen:
                gone.add((i, place))
            seen.add(line)
    cut = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in rows["quality_rules"]}
    assert dict(rows["line_dedup"]) == {i: t for i, t in cut.items() if t.strip()}

    groups = brute.near_duplicates(rows["line_dedup"], 5, 80)
    assert {i for i, _ in rows["near_duplicates"]} == {i for i, (_, first) in groups.items() if i == first}

    split = lambda t: re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    items = [split(t) for _, t in duckdb.sql(f"SELECT item_id, text FROM '{sf}/benchmark.parquet'").fetchall()]
    seeds = collections.defaultdict(set)
    for n, item in enumerate(items):
        for k in range(len(item) - 4):
            seeds[tuple(item[k : k + 5])].add(n)
    clean = set()
    for i, t in rows["near_duplicates"]:
        w = split(t)
        near = {n for k in range(len(w) - 4) for n in seeds.get(tuple(w[k : k + 5]), ())}
        if not any(brute.tiling_coverage(w, items[n], 5) >= 0.6 * len(items[n]) for n in near):
            clean.add(i)
    assert {i for i, _ in rows["decontamination"]} == clean

    packed = kept["packing"].toPandas()
    encode = tokenizer(*token_ranks()).encode
    assert packed.groupby("doc_id").length.sum().to_dict() == {
        i: len(encode_added(encode, t) + END) // 4 for i, t in rows["decontamination"]
    }
    assert packed.groupby("sequence_id").length.sum().max() <= 1024


def test_edges(spark):
    docs = brute.edge_table(spark, "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, brute.SF), "edge")
    assert docs.count() > 0
    empty = table(spark, brute.SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stored(stage(spark, empty, brute.SF), "empty")
    assert empty.count() == 0


def test_rows_that_share_an_id_or_have_none(spark):
    """One of each group stays; an unrelated text under the id of a copy stays too."""
    rng = random.Random(3)
    a, b, c = (" ".join(rng.choice("abcdefgh") + str(rng.randrange(500)) for _ in range(80)) for _ in range(3))
    rows = [(5, a), (7, a + " more"), (7, b), (None, c), (None, c), (None, c + " more"), (9, c + " again"), (None, None), (5, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, brute.SF)
    got = collections.Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert got == {(5, a): 1, (7, b): 1, (9, c + " again"): 1, (None, None): 1}


def test_stored_tables_leave_no_shuffle_files(spark):
    def files():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = {blocks.apply(i).getName() for i in range(blocks.size())}
        return {n for n in names if n.startswith("shuffle_")}

    before, setting = files(), spark.conf.get(common.SHUFFLE_CLEANUP, "false")
    table = common.stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "small")
    for _ in range(50):  # they go in the background
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert spark.conf.get(common.SHUFFLE_CLEANUP, "false") == setting and table.count() == 7
    common.release(table)
