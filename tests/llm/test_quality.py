import duckdb

import brute
import compare
from barflow.llm import quality
from barflow.llm.queries import ORACLES, QUERIES


def connection():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{brute.SF}/documents.parquet'")
    return con


def test_matches_sql(spark):
    name = "op8_quality_rules"
    text, _, ok = compare.compare(spark, connection(), brute.SF, name, QUERIES[name], ORACLES[name])
    assert ok, text


def test_repeats_and_lines(spark):
    eight = "a b c d e f g h"
    rows = [(1, f"{eight} x {eight}"), (2, f"{eight} {eight}"), (3, "x x x x x x x x x"), (4, "l\n \nl\nl\n"), (5, "## a|b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality.judge(df).collect()}
    assert [got[i]["n_repeat_words"] for i in (1, 2, 3, 4)] == [16, 16, 9, 0]
    assert got[4]["n_dup_lines"] == 2 and got[4]["n_lines"] == 3
    assert got[5]["n_symbols"] == 3 and got[5]["word_chars"] == 5


def test_edges(spark):
    df = brute.edge_table(spark, "kept", "n_words")
    kept = quality.keep_good(df)
    assert kept.columns == df.columns
    assert sorted(r["n_words"] or 0 for r in kept.collect()) == [0, 3, 3, 4, 5]
    judged = quality.judge(df.select("doc_id", "text"))
    assert judged.count() == len(brute.EDGE_ROWS)
    assert quality.keep_good(brute.empty_table(spark)).count() == 0


def test_main_path_is_native(spark):
    plan = quality.keep_good(brute.edge_table(spark, "a", "b"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
