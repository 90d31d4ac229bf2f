"""Inputs at the edges: loads of parts, odd files, other zones."""

import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from barflow.functions.timecols import local_day, zone_date
from barflow.operators.describe import describe_returns
from barflow.operators.eventstudy import event_impacts
from barflow.operators.klines import decode_payload, stored_range, validate_bars
from barflow.operators.posts import posts_since
from barflow.plans.jobs import archive_backfill_job, macro_job, silver_job
from barflow.sinks.files import write_month, write_silver
from barflow.sources.archive import archive_faults, archive_files, archive_kline_scan, archive_klines, archive_lines, archive_rejects, load_archives
from barflow.sources.files import bar_csv_scan, event_csv_scan, silver_scan
from barflow.streaming.bars import file_stream, start_files, stream_bars, stream_latest

BAR = "ts bigint, iso_ts string, symbol string, interval string, open double, high double, low double, close double, volume double"
START = 1735689600000  # 2025-01-01T00:00:00Z
MONTHS = "interval STRING, symbol STRING, month STRING"


def bars_of(spark, rows, interval="1m"):
    return spark.createDataFrame(
        [(START + m * 60_000, "x", "S", interval, o, o + 2, o - 0.5, o + 1, v) for m, o, v in rows], BAR
    )


def test_widths_keep_apart_and_parts_of_a_month_stay(spark, tmp_path):
    raw, silver = str(tmp_path / "raw"), str(tmp_path / "silver")
    days = [(d * 1440, 10.0 + d, 1.0) for d in range(31)]
    write_month(bars_of(spark, days).unionByName(bars_of(spark, [(0, 99.0, 240.0)], "4h")), raw)
    loads = [("2025-01-01", "2025-01-15"), ("2025-01-16", "2025-01-31"), ("2025-01-01", "2025-01-15")]
    for first, last in loads:
        silver_job(spark, raw, silver, first, last, interval="1m")
        assert silver_job(spark, raw, silver, first, last, interval="4h") == (first == "2025-01-01")
    rows = silver_scan(spark, silver, interval=True).collect()
    assert len([r for r in rows if r["interval"] == "1m"]) == 31
    assert [r["open"] for r in rows if r["interval"] == "4h"] == [99.0]
    with pytest.raises(TypeError):
        silver_job(spark, raw, silver, "2025-01-01", "2025-01-02")


def test_a_new_row_replaces_the_one_with_its_key(spark, tmp_path):
    path = str(tmp_path / "silver")
    old = validate_bars(bars_of(spark, [(0, 1.0, 1.0), (1, 2.0, 1.0)]), by=("interval",))
    new = validate_bars(bars_of(spark, [(1, 5.0, 3.0), (2, 6.0, 1.0)]), by=("interval",))
    assert [write_silver(df, path, mode="merge") for df in (old, new)] == [2, 2]
    assert sorted(r["open"] for r in silver_scan(spark, path, interval=True).collect()) == [1.0, 5.0, 6.0]
    with pytest.raises(ValueError, match="no partition"):
        write_silver(new.withColumn("symbol", F.lit(None).cast("string")), path, mode="merge")


def test_repeated_bars_grow(spark):
    got = validate_bars(bars_of(spark, [(0, 9.0, 1.0), (0, 4.0, 7.0), (0, 8.0, 2.0)]), latest=("volume", "close")).collect()
    assert [(r["open"], r["volume"]) for r in got] == [(4.0, 7.0)]


def test_two_files_of_one_month(spark, tmp_path):
    lake = str(tmp_path / "lake")
    line = '{"source":"manual_macro","event_type":"%s","event_name":"n","event_date":"2025-01-%02d","event_time_utc":"t","actual":"1","forecast":"1","previous":"0","units":"u"}\n'
    for name, day in (("a", 3), ("b", 4), ("a", 3)):
        file = tmp_path / f"{name}.jsonl"
        file.write_text(line % ("rate", day))
        macro_job(spark, str(file), lake)
    assert sorted(str(r["event_date"]) for r in event_csv_scan(spark, lake).collect()) == ["2025-01-03", "2025-01-04"]


def test_json_behind_white_space(spark):
    text = '{"ts":1,"symbol":"S","open":1.0,"high":2.0,"low":0.5,"close":1.5,"volume":3.0}'
    df = spark.createDataFrame([(lead + text,) for lead in ("", " ", "\t", "\n", "\r\n \t")], "value string")
    assert {(r["ts"], r["symbol"], r["volume"]) for r in decode_payload(df).collect()} == {(1, "S", 3.0)}


def test_a_header_in_another_order_is_an_error(spark, tmp_path):
    file = tmp_path / "bars.csv"
    file.write_text("ts,iso_ts,symbol,interval,low,high,open,close,volume\n1,x,S,1m,1,3,2,2.5,7\n")
    with pytest.raises(Exception, match="CSV header"):
        bar_csv_scan(spark, str(file)).collect()


def _zip(path, text):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr("bars.csv", text)
    path.write_bytes(buffer.getvalue())


def test_archive_names_and_bytes(spark, tmp_path):
    line = f"{START},1,2,0.5,1.5,3\n".encode()
    _zip(tmp_path / "AAA-1m-2025-01-05.zip", line)
    _zip(tmp_path / "BBB-4h-2025-01.zip", b"\xff\xfe,1,2,0.5,1.5,3\n" + line)
    _zip(tmp_path / "nameless.zip", line)
    (tmp_path / "CCC-1m-2025-01.zip").write_bytes((tmp_path / "BBB-4h-2025-01.zip").read_bytes()[:60])
    got = archive_kline_scan(spark, str(tmp_path)).collect()
    assert sorted((r["symbol"], r["interval"]) for r in got) == [("AAA", "1m"), ("BBB", "4h")]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(str(tmp_path))
    assert [(r["path"].rsplit("/", 1)[1], r["reason"]) for r in archive_rejects(files).collect()] == [("nameless.zip", "bad_name")]
    assert archive_klines(files).count() == 2
    out = str(tmp_path / "months")
    for _ in range(2):
        assert archive_backfill_job(spark, str(tmp_path), out, "2025-01-01", "2025-01-31") == 2
    assert bar_csv_scan(spark, out, MONTHS).count() == 2


def test_ranges_on_the_stored_time_reach_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = stored_range(events, "ts", "2024-01-15", "2024-01-15", "Europe/Berlin")._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(ts,2024-01-14T23:00" in pushed and "LessThan(ts,2024-01-15T23:00" in pushed


def test_results_do_not_depend_on_the_session_zone(spark):
    posts = [("2025-06-01T00:30:00",), ("2025-06-01",), ("2025-06-01T00:30:00Z",), ("2025-06-01T00:30:00-05:00",), ("no date",)]
    seen = set()
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            at = spark.range(48).select((F.lit(1743289200000) + F.col("id") * 3_600_000).alias("ts"))
            days = at.select(local_day(F.col("ts"), "Europe/Berlin").cast("string"), zone_date(F.timestamp_millis("ts"), "Asia/Tokyo").cast("string"))
            kept = posts_since(spark.createDataFrame(posts, "date string")).select(F.unix_millis("created_at"))
            seen.add((tuple(map(tuple, days.collect())), tuple(sorted(r[0] for r in kept.collect()))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert len(seen) == 1 and len(next(iter(seen))[1]) == 4


def test_a_constant_series_has_moments_zero(spark):
    df = spark.createDataFrame([("S", 0.25)] * 5, "symbol string, ret double")
    row = describe_returns(df).first()
    assert (row["variance"], row["skewness"], row["kurtosis"]) == (0.0, 0.0, 0.0)


def test_two_rows_on_a_date_are_one_impact(spark):
    days = [dt.date(2025, 1, d) for d in range(1, 8)]
    rows = [("S", d, 0.01 * i, 1) for i, d in enumerate(days)] + [("S", days[3], 9.0, 2)]
    returns = spark.createDataFrame(rows, "symbol string, ds date, ret double, arrival int")
    events = spark.createDataFrame([(days[1], "hike", 0.25, 1.0)], "event_date date, decision_class string, delta double, rate double")
    got = event_impacts(events, returns, "post_k_days", 3, order=("arrival",)).collect()
    assert len(got) == 1 and abs(got[0]["impact"] - (1.02 * 1.03 * 1.04 - 1)) < 1e-12


def test_streams_keep_the_last_arrival(spark, tmp_path):
    rows = [(START, 1, 1.0), (START, 2, 5.0), (START + 60_000, 3, 2.0), (START, 4, 7.0), (START + 9 * 3_600_000, 5, 1.0)]
    df = spark.createDataFrame([(t, "S", i, v, v, v, v, v) for t, i, v in rows], "ts bigint, symbol string, arrival int, open double, high double, low double, close double, volume double")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df.coalesce(1).write.parquet(source)
    latest = stream_latest(file_stream(spark, source, df.schema), ("arrival",))
    start_files(stream_bars(latest, "4h", None), out, str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(out).collect()
    assert [(r["ts"], r["open"], r["close"], r["volume"], r["rows"]) for r in got] == [(START, 7.0, 2.0, 9.0, 2)]


def test_faulty_archives_are_rejected_whole(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("bars.csv", "".join(f"{i},{i * 7919 % 10007},2,0.5,1.5,10\n" for i in range(50_000)))
    whole = buffer.getvalue()
    broken = bytearray(whole)
    broken[len(whole) // 2 : len(whole) // 2 + 40] = b"\xff" * 40
    rows = [(f"/x/{n}-1m-2025-01.zip", bytearray(c)) for n, c in (("A", whole), ("B", broken), ("C", whole[: len(whole) // 2]))]
    files = spark.createDataFrame(rows, "path string, content binary")
    counts = {r["path"][3]: r["count"] for r in archive_lines(files).groupBy("path").count().collect()}
    assert counts == {"A": 50_000}
    assert sorted((r["path"][3], r["reason"]) for r in archive_faults(files).collect()) == [("B", "bad_archive"), ("C", "bad_archive")]


def test_one_pass_over_archives_reports_what_it_leaves_out(spark, tmp_path):
    base, line = tmp_path / "zips", f"{START},1,2,0.5,1.5,3\n"
    base.mkdir()
    _zip(base / "AAA-1m-2025-01.zip", "open_time,open,high,low,close,volume\n" + line + "x,1,2,0.5,1.5,3\n" + f"{START},1,oops,0.5,1.5,3\n\n")
    _zip(base / "EEE-1m-2025-01.zip", "")
    _zip(base / "notes.zip", line)
    # 100,000 lines, so that parts of the archive have left the task before it breaks off
    _zip(base / "BBB-1m-2025-01.zip", line * 100_000)
    broken = bytearray((base / "BBB-1m-2025-01.zip").read_bytes())
    broken[len(broken) * 3 // 4] ^= 1
    (base / "BBB-1m-2025-01.zip").write_bytes(broken)
    with zipfile.ZipFile(base / "CCC-1m-2025-01.zip", "w"):
        pass
    load = load_archives(archive_files(spark, str(base)))
    name = lambda r: r["path"].rsplit("/", 1)[1][:3]
    assert [(r["symbol"], r["ts"], r["volume"]) for r in load.bars.collect()] == [("AAA", START, 3.0)]
    assert sorted((name(r), r["line_no"], r["reason"]) for r in load.rejects.collect()) == [
        ("AAA", 2, "bad_open_time"), ("AAA", 3, "bad_values"), ("AAA", 4, "bad_open_time")
    ]
    assert sorted((name(r), r["reason"]) for r in load.faults.collect()) == [
        ("BBB", "bad_archive"), ("CCC", "empty_archive"), ("not", "bad_name")
    ]
    load.drop()
    out, report = str(tmp_path / "months"), str(tmp_path / "report")
    assert archive_backfill_job(spark, str(base), out, "2025-01-01", "2025-01-31", report=report) == 1
    assert spark.read.json(f"{report}/faults").count() == 3 and spark.read.json(f"{report}/rejects").count() == 3
    with pytest.warns(UserWarning, match="3 archives"):
        assert archive_backfill_job(spark, str(base), out, "2025-01-01", "2025-01-31") == 1
    nothing = load_archives(spark.createDataFrame([], "path string, content binary"))
    assert nothing.bars.count() == nothing.rejects.count() == nothing.faults.count() == 0
    odd = spark.createDataFrame([("/x/A-1m-2025-01.zip", None, 1), (None, bytearray(b"x"), 2)], "path string, content binary, fault int")
    assert [r["reason"] for r in load_archives(odd).faults.collect()] == ["bad_archive"]
