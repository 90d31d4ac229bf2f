import datetime as dt
import glob
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from barflow.operators.bars import bars_daily, observed, resample_bars
from barflow.plans.jobs import (
    archive_backfill_job,
    forecast_job,
    gold_day_job,
    macro_job,
    macro_sentiment_job,
    posts_job,
    raw_day_job,
    silver_job,
)
from barflow.operators.klines import enrich_ticks, validate_bars, with_month
from barflow.schemas import BAR_COLUMNS, CANDLE_SCHEMA, ENVELOPE_SCHEMA, SENTIMENT_EVENT_SCHEMA, TICK_CSV_COLUMNS, TICK_SCHEMA
from barflow.session import scratch_path, shared_dir
from barflow.sinks.files import csv_append, rows_per_partition, write_gold, write_month, write_raw, write_silver
from barflow.sinks.kafka import kafka_encode
from barflow.sources.files import (
    bar_csv_scan,
    close_csv_scan,
    daily_csv_scan,
    event_csv_scan,
    macro_jsonl_scan,
    post_jsonl_scan,
    raw_day_scan,
    scored_post_scan,
    silver_scan,
)
from barflow.sources.kafka import kafka_day_options, kafka_envelope_day, offsets_by_time, security_options
from barflow.streaming.bars import file_stream, start_files, stream_bars, stream_dedup

MONTHS = "interval STRING, symbol STRING, month STRING"


def ms(text):
    return int(dt.datetime.fromisoformat(text).timestamp() * 1000)


@pytest.fixture
def bars(spark):
    rows = []
    for i in range(400):
        ts = ms("2025-01-30T20:00:00+00:00") + i * 900_000
        rows.append((ts, "x", "AB"[i % 2], "15m", 10.0 + i % 7, 20.0 + i % 5, 5.0, 11.0 + i % 4, 1.0))
    return spark.createDataFrame(rows, "ts bigint, iso_ts string, symbol string, interval string, open double, high double, low double, close double, volume double")


@pytest.fixture
def envelopes(bars):
    return bars.select(
        F.lit("t0").alias("topic"), F.lit(0).alias("partition"), F.col("ts").alias("offset"),
        F.timestamp_millis("ts").alias("timestamp"), F.lit(0).alias("timestampType"),
        F.col("symbol").alias("key"), F.to_json(F.struct(*bars.columns)).alias("value"),
    )


def test_raw_to_gold_and_again(spark, tmp_path, bars, envelopes):
    raw, gold = str(tmp_path / "raw"), str(tmp_path / "gold")
    days = ["2025-01-31", "2025-02-01"]
    for _ in range(2):  # a re-run changes nothing
        for day in days:
            raw_day_job(envelopes, raw, day)
        for day in days:
            gold_day_job(spark, raw, gold, day, topic="t0")
        got = spark.read.schema(CANDLE_SCHEMA).parquet(gold)
        want = bars_daily(bars).where(F.col("day").isin(days))
        columns = want.columns
        assert sorted(got.select(columns).collect()) == sorted(want.collect())


def test_gold_reads_the_neighbouring_utc_date(spark, tmp_path, bars, envelopes):
    raw = str(tmp_path / "raw")
    write_raw(envelopes.withColumn("date", F.to_date("timestamp")), raw, fmt="json")
    gold = str(tmp_path / "gold")
    rows = gold_day_job(spark, raw, gold, "2025-01-31", fmt="json")
    want = bars_daily(bars).where("day = '2025-01-31'")
    assert rows == want.count() == 2
    assert sorted(spark.read.schema(CANDLE_SCHEMA).parquet(gold).select(want.columns).collect()) == sorted(want.collect())
    plan = raw_day_scan(spark, raw, "2025-01-31", "t0", "json")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(ValueError):
        write_raw(envelopes, raw, fmt="orc")


def test_append_adds_rows(spark, tmp_path, bars):
    path = str(tmp_path / "gold")
    candles = bars_daily(bars)
    n = write_gold(candles, path)
    write_gold(candles, path, mode="append")
    assert spark.read.parquet(path).count() == 2 * n


def test_month_files_are_sorted_and_feed_silver(spark, tmp_path, bars):
    raw, silver = str(tmp_path / "months"), str(tmp_path / "silver")
    assert write_month(bars, raw) == 400
    assert sorted(bar_csv_scan(spark, raw, MONTHS).select(*BAR_COLUMNS).collect()) == sorted(bars.select(*BAR_COLUMNS).collect())
    files = glob.glob(f"{raw}/interval=15m/symbol=*/month=*/*.csv")
    assert {f.split("/month=")[1][:7] for f in files} == {"2025-01", "2025-02"}
    for name in files:
        stamps = [int(line.split(",")[0]) for line in open(name).read().splitlines()[1:]]
        assert stamps == sorted(stamps)
    for fmt in ("parquet", "csv"):
        out = f"{silver}-{fmt}"
        n = silver_job(spark, raw, out, "2025-01-31", "2025-02-01", symbols=["A"], fmt=fmt, interval="15m")
        table = spark.read.option("header", "true").format(fmt).load(out)
        assert n == table.count() == 96 and {r.symbol for r in table.select("symbol").distinct().collect()} == {"A"}
    assert {(r.year, r.month, r.rows) for r in rows_per_partition(table, ["year", "month"]).collect()} == {(2025, 1, 48), (2025, 2, 48)}


def test_one_hot_partition_is_split_between_tasks(spark, tmp_path):
    hot = spark.range(40_000).select(
        (F.lit(ms("2025-01-01T00:00:00+00:00")) + F.col("id") * 10).alias("ts"), F.lit("x").alias("iso_ts"),
        F.when(F.col("id") % 10 == 0, "B").otherwise("A").alias("symbol"), F.lit("1m").alias("interval"),
        *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close", "volume")],
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_month(hot, str(tmp_path / "m"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted(glob.glob(str(tmp_path / "m/interval=1m/symbol=A/month=2025-01/*.csv")))
    assert len(files) > 1
    ranges = [[int(line.split(",")[0]) for line in open(f).read().splitlines()[1:]] for f in files]
    assert sum(map(len, ranges)) == 36_000
    assert all(a[-1] < b[0] for a, b in zip(ranges, ranges[1:]))


def _zip(path, text, member="bars.csv"):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        if text is not None:
            z.writestr(member, text)


def test_archives(spark, tmp_path):
    base = tmp_path / "archives" / "deep"
    os.makedirs(base)
    start = ms("2025-01-01T00:00:00+00:00")
    lines = "".join(f"{start + i * 60000},1,2,0.5,1.5,3,more,fields\n" for i in range(45_000))
    _zip(base / "BTCUSDT-1m-2025-01.zip", "open_time,open,high,low,close,volume\r\n" + lines)
    _zip(base / "ETHUSDT-4h-2025-02.zip", f'"{(start + 5) * 1000}","1","2","0.5","1.5","3"\r\n\r\nbad line\n')
    _zip(base / "EMPTY-1d-2025-01.zip", None)
    (base / "BROKEN-1m-2025-01.zip").write_bytes(b"not a zip")
    (base / "readme.txt").write_text("ignored")
    out = str(tmp_path / "months")
    assert archive_backfill_job(spark, str(tmp_path / "archives"), out, "2025-01-01", "2025-01-31") == 44_641
    got = {(r.interval, r.symbol): r.rows for r in rows_per_partition(bar_csv_scan(spark, out, MONTHS), ["interval", "symbol"]).collect()}
    assert got == {("1m", "BTCUSDT"): 44_640, ("4h", "ETHUSDT"): 1}
    eth = bar_csv_scan(spark, out, MONTHS).where("symbol = 'ETHUSDT'").head()
    assert eth.ts == start + 5 and eth.iso_ts == "2025-01-01T00:00:00.005000Z"


def test_macro_lake(spark, tmp_path):
    lines = tmp_path / "events.jsonl"
    rows = [
        {"source": "manual_macro", "event_type": "cpi", "event_name": 'say "hi", ok', "event_date": "2025-01-15", "event_time_utc": "2025-01-15T13:30:00Z",
         "actual": 3.0, "forecast": 2.9, "previous": 2.8, "units": "percent", "extra": {"local_time_str": "14:30"}},
        {"source": "manual_macro", "event_type": "fed_rate", "event_date": "2025-02-15", "actual": None, "forecast": "4.5", "previous": 4.5, "extra": None},
    ]
    lines.write_text("\n".join(json.dumps(r) for r in rows))
    lake = str(tmp_path / "lake")
    assert macro_jsonl_scan(spark, str(lines)).count() == 2
    for _ in range(2):
        assert macro_job(spark, str(lines), lake) == 2
        assert macro_sentiment_job(spark, lake) == 2
    assert event_csv_scan(spark, lake, "manual_macro").count() == 2
    scored = {r.event_type: r for r in event_csv_scan(spark, lake, "macro_sentiment", sentiment=True).collect()}
    assert scored["cpi"].event_sentiment == -1 and scored["cpi"].event_name == 'say "hi", ok'
    assert scored["fed_rate"].event_sentiment == 0 and scored["fed_rate"].forecast == 4.5
    assert scored["cpi"].event_id == "cpi-2025-01-15" and scored["cpi"].event_month == 1
    assert list(scored["cpi"].asDict()) == SENTIMENT_EVENT_SCHEMA.fieldNames()


def test_posts_job(spark, tmp_path):
    lines = tmp_path / "posts.jsonl"
    good = "Tariffs and interest rates decide the next quarter,\nsays \"everyone\" here"
    rows = [json.dumps({"date": "2025-02-01T10:00:00Z", "text": good}), "", "{broken", json.dumps({"date": "", "text": "x"}),
            json.dumps({"text": "no date"}), json.dumps({"date": "2025-02-01T10:00:00Z", "text": "  "}), json.dumps({"date": "2025-02-03T10:00:00Z", "text": "hello"})]
    lines.write_text("\n".join(rows))
    assert post_jsonl_scan(spark, str(lines)).count() == 2

    def model(text):
        return F.struct(F.lit(0.2).alias("positive"), F.lit(0.6).alias("negative"))

    out = str(tmp_path / "out")
    assert posts_job(spark, str(lines), out, model) == 1
    reader = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"')
    r = reader.csv(out).head()
    assert r.raw_text == good and r.sentiment_label == "negative" and r.market_bias == "bearish"
    assert str(r.event_date) == "2025-02-01" and r.is_economic == "true"


def test_equal_posts_of_several_loads(spark, tmp_path):
    """Equal posts with ids of their own all stay, a load that comes again changes nothing."""
    post = {"date": "2025-02-01T10:00:00Z", "text": "Tariffs and interest rates decide the next quarter"}
    loads = {"a": [{**post, "id": "1"}, {**post, "id": "2"}], "b": [{**post, "id": "3"}], "c": [post, post]}

    def model(text):
        return F.struct(F.lit(0.2).alias("positive"), F.lit(0.6).alias("negative"))

    out = str(tmp_path / "out")
    for name in ("a", "b", "a", "c", "c", "b"):
        path = tmp_path / f"{name}.jsonl"
        path.write_text("\n".join(map(json.dumps, loads[name])))
        assert posts_job(spark, str(path), out, model) == len(loads[name])
    ids = [r.truth_id for r in scored_post_scan(spark, out).collect()]
    assert sorted(ids, key=str) == ["1", "2", "3", None, None]


def test_daily_csv_and_forecasts(spark, tmp_path):
    rows = [("ignored", f"2025-01-{d:02d}T00:00:00Z", "A", 100.0 + d * (-1) ** d) for d in range(1, 29)]
    path, out = str(tmp_path / "daily"), str(tmp_path / "out")
    spark.createDataFrame(rows, "note string, iso_ts string, symbol string, close double").write.option("header", "true").csv(path)
    assert daily_csv_scan(spark, path).columns == ["iso_ts", "symbol", "close"]
    assert forecast_job(spark, path, out, "2025-01-27", "2025-01-30") == 4
    got = spark.read.option("header", "true").option("inferSchema", "true").csv(out)
    assert got.where("actual_close is not null").count() == 2
    assert forecast_job(spark, path, str(tmp_path / "next")) == 1
    with pytest.raises(ValueError, match="close"):
        bad = str(tmp_path / "bad")
        spark.createDataFrame([("a", "b")], "iso_ts string, symbol string").write.option("header", "true").csv(bad)
        daily_csv_scan(spark, bad)


def test_close_csv(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.createDataFrame([(1.5, "2025-01-01"), (2.5, "2025-01-02")], "close double, date string")
    assert csv_append(df, path, ("close", "date")) == 2
    assert csv_append(df.withColumn("extra", F.lit(1)), path, ("close", "date")) == 2
    got = close_csv_scan(spark, path, "X")
    assert got.columns == ["symbol", "ds", "close"] and got.count() == 4 and {r.close for r in got.collect()} == {1.5, 2.5}
    with pytest.raises(ValueError):
        csv_append(df, path, ("missing",))


def test_kafka_options_and_envelopes(spark, envelopes):
    options = kafka_day_options("host:9092", "t0", "2025-03-30", security=security_options("u", 'p"w'))
    assert int(options["endingTimestamp"]) - int(options["startingTimestamp"]) == 23 * 3_600_000
    assert options["startingOffsetsByTimestampStrategy"] == "latest" and options["failOnDataLoss"] == "false"
    assert options["kafka.sasl.jaas.config"].endswith('username="u" password="p\\"w";')
    day = kafka_envelope_day(envelopes, "2025-01-31")
    assert day.columns == [*ENVELOPE_SCHEMA.fieldNames(), "date"] and {str(r.date) for r in day.collect()} == {"2025-01-31"}
    assert day.count() == 96
    first = offsets_by_time(envelopes, "2025-01-31").head()
    assert first.start_offset == min(r.offset for r in day.collect()) and first.end_offset > max(r.offset for r in day.collect())
    last = envelopes.agg(F.max("offset")).head()[0]
    empty = offsets_by_time(envelopes, "2030-01-01").head()
    assert (empty.start_offset, empty.end_offset) == (last + 1, last + 1)


def test_tick_sink_keeps_its_columns(spark, tmp_path):
    ticks = spark.createDataFrame([(0, "A", 1.5), (1500, "B", 2.5)], "ts bigint, symbol string, price double")
    tagged = enrich_ticks(ticks)
    assert tagged.columns == TICK_SCHEMA.fieldNames()
    path = str(tmp_path / "ticks")
    assert csv_append(tagged, path, TICK_CSV_COLUMNS) == 2
    names = [f for f in TICK_SCHEMA.fields if f.name in TICK_CSV_COLUMNS]
    got = spark.read.schema(type(TICK_SCHEMA)(names)).option("header", "true").csv(path).orderBy("ts").collect()
    assert [tuple(r) for r in got] == [(0, "1970-01-01T00:00:00+00:00", "A", 1.5), (1500, "1970-01-01T00:00:01.500000+00:00", "B", 2.5)]


def test_silver_csv_reads_back(spark, tmp_path, bars):
    path = str(tmp_path / "silver")
    valid = with_month(validate_bars(bars))
    write_silver(validate_bars(bars), path, fmt="csv")
    got = silver_scan(spark, path, "csv").select(*valid.columns)
    assert sorted(got.collect()) == sorted(valid.collect())


def test_message_keys(spark):
    df = spark.createDataFrame([("A", "x", None), ("", "kline", 1.5), (None, None, 2.0)], "symbol string, event_type string, price double")
    got = kafka_encode(df).collect()
    assert [r.key for r in got] == ["A", "kline", "event"]
    assert json.loads(got[0].value) == {"symbol": "A", "event_type": "x", "price": None}
    assert kafka_encode(df.select("price")).head().key == "event"


def test_observed_counts_during_the_write(spark, tmp_path):
    df, seen = observed(spark.range(123))
    df.write.parquet(str(tmp_path / "n"))
    assert seen.get["rows"] == 123


def test_stream_bars_equal_batch_for_closed_windows(spark, tmp_path, bars):
    source = str(tmp_path / "in")
    bars.repartition(3).write.parquet(source)
    stream = file_stream(spark, source, bars.schema)
    out = str(tmp_path / "out")
    rolled = stream_bars(stream, "1h", "2 hours")
    start_files(rolled, out, str(tmp_path / "state")).awaitTermination()
    limit = bars.agg(F.max("ts")).head()[0] - 2 * 3_600_000
    want = resample_bars(bars, "1h").where(F.col("ts") + 3_600_000 <= limit)
    got = spark.read.schema(rolled.schema).parquet(out)
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect()) and want.count() > 100
    # Restarting from the checkpoint adds nothing.
    start_files(stream_bars(stream, "1h", "2 hours"), out, str(tmp_path / "state")).awaitTermination()
    assert spark.read.schema(rolled.schema).parquet(out).count() == want.count()


def test_stream_dedup(spark, tmp_path, bars):
    source = str(tmp_path / "in")
    bars.unionByName(bars).coalesce(1).write.parquet(source)
    kept = stream_dedup(file_stream(spark, source, bars.schema))
    assert kept.columns == bars.columns
    out = str(tmp_path / "out")
    start_files(kept, out, str(tmp_path / "state")).awaitTermination()
    assert spark.read.schema(bars.schema).parquet(out).count() == bars.count()


def test_shared_folder_is_used(spark):
    base = shared_dir(spark)
    assert scratch_path(spark, "x").startswith(base + "/x-") and scratch_path(spark, "x") != scratch_path(spark, "x")
