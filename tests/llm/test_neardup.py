import random

import brute
from barflow.llm import buckets, common, components, neardup
from barflow.llm.queries import QUERIES
from barflow.session import path_exists


def test_matches_brute_force(spark):
    want = brute.near_duplicates(brute.documents(), 3, 85)
    got = QUERIES["op5_near_duplicates"](spark, brute.SF).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_a_group_of_near_copies(spark, monkeypatch):
    """More near copies than a block has rows, at similarities around the threshold."""
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 16)
    rng = random.Random(4)
    base = [rng.choice("abcdefghij") + str(rng.randrange(300)) for _ in range(120)]
    docs = [(1000, " ".join(base))]
    for i in range(120):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 3, 5, 8])):
            copy[rng.randrange(len(copy))] = f"new{i}x{rng.randrange(99)}"
        docs.append((i, " ".join(copy)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = neardup.near_duplicates(df, neardup.Settings(words=3, percent=85, bands=30)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute.near_duplicates(docs, 3, 85)


def test_pruning_bounds_keep_pairs_at_the_threshold():
    settings = neardup.Settings(words=3, percent=85, bands=30)
    rng, kept = random.Random(2), 0
    for _ in range(2000):
        same = [rng.random() < 0.85 for _ in range(settings.hashes)]
        kept += all(sum(same[:n]) >= least for n, least in neardup.least_matches(settings))
    assert kept == 2000
    assert neardup.least_matches(settings)[0][1] > 5


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 150), (150, 170)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(df).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[101] == 100 and got[200] == got[170] == 150
    assert components.connected_components(df.limit(0)).count() == 0


def test_few_tables_for_the_components(spark, monkeypatch):
    """Edges that one task reads are one table; rounds that find no link make none."""
    written, stored = [], common.stored
    for module in (buckets, components):
        monkeypatch.setattr(module, "stored", lambda df, name: written.append(name) or stored(df, name))
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(7, 7)], "a long, b long").coalesce(1)
    got = {r["node"]: r["component"] for r in components.connected_components(chain).collect()}
    assert got == dict.fromkeys(range(41), 0) and written == ["edges"]
    written.clear()
    members = spark.range(60).selectExpr("id % 2 AS bucket", "id AS node", "1 AS size")
    got = buckets.bucket_components(members, lambda pairs: pairs.where("b - a > 1000"))
    assert got.count() == 0 and written == ["links", "edges", "labelled", "links", "links"]


def test_portions_of_edges(spark, monkeypatch):
    """However the edges are cut into portions, components are those of all of them."""
    monkeypatch.setattr(components, "PORTION_EDGES", 1)
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    least = {n: n for edge in edges for n in edge}
    for _ in least:
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    df = spark.createDataFrame([e for e in edges if e[0] != e[1]], "a long, b long").repartition(7)
    got = {r["node"]: r["component"] for r in components.connected_components(df).collect()}
    assert got == {n: least[n] for e in edges if e[0] != e[1] for n in e}


def test_bucket_rounds_find_every_component(spark):
    """Links only between neighbours in one large bucket."""
    members = spark.range(60).selectExpr("0L AS bucket", "id AS node", "1 AS size")
    got = buckets.bucket_components(members, lambda pairs: pairs.where("b - a = 1 AND b % 10 <> 0"), hubs=2, hub_rounds=1)
    assert {r["node"]: r["component"] for r in got.collect()} == {i: i // 10 * 10 for i in range(60)}


def test_edges(spark):
    df = brute.edge_table(spark, "node", "bucket")
    got = neardup.near_duplicates(df)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(brute.EDGE_ROWS)
    assert {r[2] for r in rows if r[0] in (3, 4, None)} == {3}
    assert (1, 0, 1, True) in rows and (2, 0, 2, True) in rows and (7, 0, 7, True) in rows
    assert neardup.near_duplicates(brute.empty_table(spark)).count() == 0


def test_only_the_tables_of_the_result_are_left(spark, monkeypatch):
    made = []
    write = common.scratch_path
    monkeypatch.setattr(common, "scratch_path", lambda session, name: made.append((name, write(session, name))) or made[-1][1])
    docs = spark.createDataFrame(brute.documents(), "doc_id long, text string")
    out = neardup.near_duplicates(docs)
    left = lambda: sorted(name for name, path in made if path_exists(spark, path))
    assert left() == ["edges", "nodes", "signatures"] and out.count() == docs.count()
    made.clear()
    monkeypatch.setattr(neardup, "bucket_components", None)
    try:
        neardup.near_duplicates(docs)
    except TypeError:
        pass
    assert made and left() == []
