import duckdb

import brute
import compare
from barflow.llm import licenses
from barflow.llm.queries import ORACLES, QUERIES


def test_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{brute.SF}/documents.parquet'")
    name = "op3_license_scan"
    text, _, ok = compare.compare(spark, con, brute.SF, name, QUERIES[name], ORACLES[name])
    assert ok, text


def test_every_template_is_found_anywhere(spark):
    rows, want = [], {}
    for name, texts in licenses.TEMPLATES.items():
        for text in texts:
            for shift in range(0, 40, 3):
                filler = [f"w{i}" for i in range(200)]
                rows.append((len(rows), " ".join(filler[:shift]) + " " + text.upper() + " " + " ".join(filler[shift:])))
                want[rows[-1][0]] = (name, shift)
    got = {r["doc_id"]: r["matches"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc_id, (name, shift) in want.items():
        assert name in {m["license"] for m in got[doc_id]}, (name, shift)
        match = next(m for m in got[doc_id] if m["license"] == name)
        assert match["containment"] == 1.0 and match["first_word"] == shift


def test_changed_words_and_bounds(spark):
    text = licenses.TEMPLATES["GPL-3.0"][1]
    changed, broken = text.replace("option", "choice"), " ".join(text.split()[::2])
    df = spark.createDataFrame([(1, changed), (2, broken), (3, f"{text} {'between ' * 90} {text}")], "doc_id long, text string")
    got = {r["doc_id"]: r["matches"] for r in licenses.scan(df).collect()}
    assert 0.8 <= got[1][0]["containment"] < 1 and not got[2] and len(got[3]) == 2
    assert all(licenses.miss_probability(n, 1.0) < 2e-5 for n in range(5, 300))


def test_edges(spark):
    df = brute.edge_table(spark, "matches", "license")
    assert licenses.scan(df).count() == len(brute.EDGE_ROWS)
    assert licenses.scan(brute.empty_table(spark)).count() == 0
    assert [len(r["matches"]) for r in licenses.scan(df, {"own": [brute.PROSE]}).where("doc_id = 3").collect()] == [1, 1]


def test_confusable_licences_are_told_apart(spark):
    gpl, cc = licenses.TEMPLATES["GPL-3.0"], licenses.TEMPLATES["CC-BY-4.0"][0]
    want = [(name, text) for name, texts in (licenses.TEMPLATES | licenses.VARIANTS).items() for text in texts]
    want += [("GPL-2.0", text.replace("version 3", "version 2")) for text in gpl]
    want += [(None, text.replace("version 3", "version 1")) for text in gpl]
    want += [("CC-BY-SA-4.0", cc.replace("Attribution", "Attribution-ShareAlike")), ("GPL-3.0", gpl[1].replace("option", "choice"))]
    rows = [(i, f"some words before {text} and some after") for i, (_, text) in enumerate(want)]
    got = {r["doc_id"]: r["matches"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (name, text) in enumerate(want):
        assert {m["license"] for m in got[i]} == ({name} if name else set()), text
    both = spark.createDataFrame([(1, f"{gpl[1]} {licenses.VARIANTS['GPL-2.0'][1]}")], "doc_id long, text string")
    assert [m["license"] for m in licenses.scan(both).first()["matches"]] == ["GPL-2.0", "GPL-3.0"]
