import itertools
import zlib

import brute
from barflow.llm import sharding
from barflow.llm.queries import QUERIES


def test_differencing_is_close_to_the_best_split():
    sizes = [(i, s) for i, s in enumerate([97, 83, 61, 59, 47, 31, 23, 11, 7, 5])]
    plan = sharding.differencing(sizes, 3)
    sums = [sum(s for k, s in sizes if plan[k] == shard) for shard in range(3)]
    best = min(
        max(t) - min(t)
        for cut in itertools.product(range(3), repeat=len(sizes))
        for t in [[sum(s for (k, s), c in zip(sizes, cut) if c == shard) for shard in range(3)]]
    )
    assert sorted(plan) == list(range(10)) and max(sums) - min(sums) <= best + 4


def test_bytes_groups_and_places(spark):
    got = QUERIES["op1_shards"](spark, brute.SF).toPandas()
    docs = dict(brute.documents())
    assert sorted(got.doc_id) == sorted(docs)
    for row in got.itertuples():
        data = docs[row.doc_id].encode()
        assert row.size == len(data) + 1 and row.text_crc32 == zlib.crc32(data)
    sums = got.groupby("shard")["size"].sum()
    assert len(sums) == 8 and sums.max() - sums.min() <= 0.001 * sums.mean()
    assert got.assign(text=got.doc_id.map(docs)).groupby("text").shard.nunique().max() == 1
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


def test_edges_and_a_hot_text(spark):
    df = brute.edge_table(spark, "size", "shard")
    got = sharding.assign_shards(df, 4).toPandas()
    assert len(got) == len(brute.EDGE_ROWS) and (got.groupby("shard").slot.max() + 1).sum() == len(got)
    hot = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE string(id) END AS text")
    placed = sharding.assign_shards(hot, 4, blocks=64).toPandas()
    assert (placed.groupby("shard").slot.nunique() == placed.groupby("shard").size()).all()
    assert (placed.groupby("shard").slot.max() + 1 == placed.groupby("shard").size()).all()
    assert sharding.assign_shards(brute.empty_table(spark)).count() == 0


def test_written_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    sharding.write_shards(df, str(tmp_path / "shards"), 4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(r["text"] for r in back.collect()) == sorted(f"text {i}" for i in range(20))
    assert back.select("shard").distinct().count() == 4
