import pytest
from pyspark.sql import functions as F

from barflow.session import drop_path, path_exists
from barflow.sources.files import silver_scan
from barflow.streaming import merge
from barflow.streaming.bars import file_stream
from barflow.streaming.merge import merge_batch, revised_scan, start_merge

START = 1735689600000  # 2025-01-01T00:00:00Z
MONTH = 31 * 86_400_000
SHAPE = "ts bigint, symbol string, rev int, open double, high double, low double, close double, volume double, fault int"


def arrivals(spark, *rows):
    """(ts, symbol, revision, price); a price of 0 makes an invalid bar."""
    return spark.createDataFrame([(t, s, r, p, p, p, p, 1.0, 0) for t, s, r, p in rows], SHAPE)


def table(spark, path):
    return sorted((r["symbol"], int(r["ms"]), r["revision"], r["close"]) for r in revised_scan(spark, path).withColumn("ms", F.unix_millis("open_ts")).collect())


def test_order_of_batches_and_replays_do_not_matter(spark, tmp_path):
    first = arrivals(spark, (START, "A", 1, 1.0), (START, "A", 3, 3.0), (START, "B", 1, 9.0), (START + MONTH, "A", 1, 5.0))
    second = arrivals(spark, (START, "A", 2, 2.0), (START, "B", 4, 8.0), (START, "B", 5, 0.0), (START, None, 1, 1.0))
    want = [("A", START, 3, 3.0), ("A", START + MONTH, 1, 5.0), ("B", START, 4, 8.0)]
    for n, order in enumerate(((first, second), (second, first), (first, second, first))):
        path, log = str(tmp_path / f"t{n}"), str(tmp_path / f"log{n}")
        for i, batch in enumerate(order):
            merge_batch(batch, i, path, log, "rev")
        assert table(spark, path) == want
        assert silver_scan(spark, path).count() == 3
        # a batch that is done is not merged again, whatever it holds
        merge_batch(arrivals(spark, (START, "A", 99, 7.0)), len(order) - 1, path, log, "rev")
        assert table(spark, path) == want
        assert not path_exists(spark, f"{log}/batch-0") and path_exists(spark, f"{log}/done/{len(order) - 1}")


def test_edges(spark, tmp_path):
    path, log = str(tmp_path / "t"), str(tmp_path / "log")
    merge_batch(arrivals(spark).limit(0), 0, path, log, "rev")
    assert not path_exists(spark, path)
    merge_batch(arrivals(spark, (START, "A", None, 1.0), (START, "A", None, 2.0)), 1, path, log, "rev")
    assert table(spark, path) == [("A", START, None, 2.0)]
    merge_batch(arrivals(spark, (START, "A", -5, 1.5), (START, "A", -5, 1.25)), 2, path, log, "rev")
    assert table(spark, path) == [("A", START, -5, 1.5)]
    merge_batch(arrivals(spark).limit(0), 3, path, log, "rev")
    assert table(spark, path) == [("A", START, -5, 1.5)]


def test_a_failure_in_the_overwrite_is_made_good(spark, tmp_path, monkeypatch):
    path, log = str(tmp_path / "t"), str(tmp_path / "log")
    merge_batch(arrivals(spark, (START, "A", 1, 1.0), (START + 60_000, "A", 1, 1.0)), 0, path, log, "rev")
    late = arrivals(spark, (START, "A", 2, 2.0))

    def breaks(df, *args, **options):
        drop_path(spark, f"{path}/symbol=A")  # the old months are gone, the new ones are not there yet
        raise OSError("no more")

    whole = merge.write_partitioned
    monkeypatch.setattr(merge, "write_partitioned", breaks)
    with pytest.raises(OSError):
        merge_batch(late, 1, path, log, "rev")
    monkeypatch.setattr(merge, "write_partitioned", whole)
    merge_batch(late, 1, path, log, "rev")
    assert table(spark, path) == [("A", START, 2, 2.0), ("A", START + 60_000, 1, 1.0)]


def test_a_correction_long_after_the_bar(spark, tmp_path):
    source, path, state = (str(tmp_path / n) for n in ("in", "t", "state"))
    arrivals(spark, *[(START + i * 60_000, "A", 1, 1.0 + i) for i in range(50)]).coalesce(1).write.parquet(source)
    stream = file_stream(spark, source, arrivals(spark).schema)
    start_merge(stream, path, state, "rev").awaitTermination()
    arrivals(spark, (START + 7 * 60_000, "A", 2, 70.0), (START + 3 * MONTH, "A", 1, 4.0)).coalesce(1).write.mode("append").parquet(source)
    for checkpoint in (state, state, str(tmp_path / "other")):
        start_merge(stream, path, checkpoint, "rev").awaitTermination()
        got = table(spark, path)
        assert len(got) == 51 and got[7] == ("A", START + 7 * 60_000, 2, 70.0)
