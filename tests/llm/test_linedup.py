import random

import brute
from barflow.llm import linedup
from barflow.llm.queries import QUERIES


def test_edit_distance_and_buckets():
    rng = random.Random(3)
    for _ in range(6000):
        a = [rng.choice("abc") for _ in range(rng.randrange(15))]
        b = list(a)
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = rng.choice(["", "a", "b"])
        a, b = "".join(a), "".join(b)
        distance = brute.edit_distance(a, b)
        assert all(linedup.within(a, b, k) == (distance <= k) for k in (1, 2, 3))
        if distance <= 2 and min(len(a), len(b)) >= 3:
            keys = [set(), set()]
            for at, found in linedup.bucket_keys([a, b], 2):
                for i, key in zip(at, found, strict=True):
                    keys[i].add(int(key))
            assert keys[0] & keys[1], (a, b)


def test_long_lines_on_the_band():
    a = "x" + "abcdefghij" * 300 + "y"
    b = "z" + a[1:1500] + a[1501:-1] + "w"
    assert linedup.within(a, b, 3) and not linedup.within(a, b, 2)


def removed(df):
    return {(r["doc_id"], p) for r in df.collect() for p in r[-1]}


def test_matches_brute_force(spark):
    docs = brute.documents()
    docs += [(1000 + i, t.replace("th", "ht", 1)) for i, t in docs[:40]]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = linedup.dedup_lines(df)
    want = brute.line_removals(docs, 2, 20)
    assert removed(out) == want and want
    texts = dict(docs)
    for row in out.collect():
        lines = texts[row["doc_id"]].split("\n")
        assert row["text"] == "\n".join(x for i, x in enumerate(lines) if (row["doc_id"], i) not in want)


def test_edges(spark):
    df = brute.edge_table(spark, "doc_a", "places_removed")
    out = linedup.dedup_lines(df)
    assert out.columns[:4] == df.columns and out.columns[4] == "places_removed_"
    rows = out.collect()
    assert len(rows) == len(brute.EDGE_ROWS)
    by_text = {r["places_removed"]: r["text"] for r in rows if r["places_removed"]}
    # the null id comes first and keeps the line; the equal lines of other documents go
    assert by_text[5] == brute.PROSE and by_text[4] == ""
    assert [r["text"] for r in rows if r["places_removed"] == 3] == ["", ""]
    assert [r["text"] for r in rows if r["doc_id"] == 1] == [None]
    assert linedup.dedup_lines(brute.empty_table(spark)).count() == 0


def test_near_lines_fall_to_the_first(spark):
    line = "a line that is long enough to count for number {}"
    rows = [(i, line.format(i) + "\nshort") for i in (10, 11, 12)] + [(20, line.format("one hundred"))]
    out = linedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {
        10: line.format(10) + "\nshort", 11: "short", 12: "short", 20: line.format("one hundred"),
    }


def test_query_takes_out_equal_short_lines(spark):
    docs = brute.documents()
    seen, short = set(), set()
    for i, t in sorted(docs):
        for place, line in enumerate(x.strip(linedup.SPACES) for x in (t or "").split("\n")):
            if 0 < len(line) < 20 and line in seen:
                short.add((i, place))
            seen.add(line)
    got = QUERIES["op4_line_dedup"](spark, brute.SF).collect()
    assert short and {(r["doc_id"], p) for r in got for p in r["places_removed"]} == brute.line_removals(docs, 2, 20) | short


def test_short_lines_only_by_equality(spark):
    rows = [(1, "a short line\n\nshort"), (2, "a short lime\n\n short \nend"), (3, "\nshort\na short line")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = linedup.dedup_lines(df, linedup.Settings(exact_short=True))
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "a short line\n\nshort", 2: "a short lime\n\nend", 3: ""}


def test_very_many_lines_take_linear_time(spark):
    text = "\n".join(["the same line of this long text again and again", ""] * 150_000)
    df = spark.createDataFrame([(1, text), (2, "another line which is long enough")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in linedup.dedup_lines(df).collect()}
    assert len(rows[1]["places_removed"]) == 149_999 and rows[2]["text"] == "another line which is long enough"
    assert rows[1]["text"] == "the same line of this long text again and again" + "\n" * 150_000


def test_buckets_are_made_once(spark, monkeypatch):
    """The count of a bucket's lines and the join with it read one exchange."""
    plans = {}

    def kept(df, name):
        if name == "buckets":
            df.collect()
            plans[name] = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        return stored(df, name)

    stored = linedup.stored
    monkeypatch.setattr(linedup, "stored", kept)
    rows = [(i, f"line number {i % 7} that is shared by a few texts\nand one of its own: {i}") for i in range(40)]
    linedup.line_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert plans["buckets"].count("MapInArrow") == 1 and "ReusedExchange" in plans["buckets"]
