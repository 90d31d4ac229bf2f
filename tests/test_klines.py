import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from barflow.functions.checks import require_columns
from barflow.functions.timecols import interval_ms, iso_from_ms, local_day_bounds_ms
from barflow.operators.bars import bars_daily, resample_bars, resample_cascade
from barflow.operators.klines import (
    api_page_bars,
    api_page_rejects,
    bars_in_range,
    decode_payload,
    dedup_rows,
    kline_rejects,
    local_day_filter,
    month_batches,
    parse_kline_rows,
    rule_violations,
    validate_bars,
)
from barflow.constants import INTERVAL_SECONDS
from conftest import rows_by

BAR = "symbol string, ts bigint, open double, high double, low double, close double, volume double"


def ms(text):
    return int(dt.datetime.fromisoformat(text).timestamp() * 1000)


def test_decode_chooses_one_decoder_per_row(spark):
    full = {"ts": 1, "iso_ts": "x", "symbol": "A", "interval": "1m", "open": 1.5, "high": 2.0,
            "low": 1.0, "close": 1.25, "volume": 3.0}
    partial = {"ts": 2, "symbol": "B"}
    rows = [
        (0, json.dumps(full)), (1, '3,"y,z",C,1m,1,2,0.5,1.5,9'), (2, json.dumps(partial)),
        (3, "garbage"), (4, None), (5, '  {"ts": 7}'), (6, "{broken"),
    ]
    out = rows_by(decode_payload(spark.createDataFrame(rows, "id int, value string"), keep=("id",)), "id")
    assert out[0].open == 1.5 and out[0].iso_ts == "x"
    assert out[1].ts == 3 and out[1].iso_ts == "y,z" and out[1].volume == 9.0
    assert out[2].symbol == "B" and out[2].iso_ts is None and out[2].open is None
    assert out[3].ts is None and out[4].ts is None and out[6].ts is None
    assert out[5].ts == 7
    assert len(out) == len(rows)


def test_parse_kline_rows_and_rejects(spark):
    good = ["1.0", "2.0", "0.5", "1.5", "10"]
    rows = [
        ("ms", "1735689600000", *good), ("us", "1735689600123456", *good), ("ms_part", "1735689600005", *good),
        ("text", "abc", *good), ("old", "1483228799999", *good), ("first", "1483228800000", *good),
        ("late", "4102444800001", *good), ("last", "4102444800000", *good), ("null", None, *good),
        ("nan", "1735689600000", "nan", *good[1:]), ("hole", "1735689600000", None, *good[1:]),
        ("suffix", "1735689600000", "1d", *good[1:]), ("exp", "1735689600000", "1e3", *good[1:]),
        ("blank", " 1735689600000 ", " 1.0 ", *good[1:]),
    ]
    names = "symbol string, open_time string, open string, high string, low string, close string, volume string"
    df = spark.createDataFrame(rows, names).withColumn("interval", F.lit("1m"))
    ok = rows_by(parse_kline_rows(df), "symbol")
    assert set(ok) == {"ms", "us", "ms_part", "first", "last", "exp", "blank"}
    assert ok["us"].ts == 1735689600123 and ok["us"].iso_ts == "2025-01-01T00:00:00.123000Z"
    assert ok["ms"].iso_ts == "2025-01-01T00:00:00Z"
    assert ok["ms_part"].iso_ts == "2025-01-01T00:00:00.005000Z"
    assert ok["exp"].open == 1000.0
    reasons = {k: r.reason for k, r in rows_by(kline_rejects(df), "symbol").items()}
    assert reasons == {
        "text": "bad_open_time", "null": "bad_open_time", "old": "out_of_range", "late": "out_of_range",
        "nan": "bad_values", "hole": "bad_values", "suffix": "bad_values",
    }


def test_iso_text_keeps_the_sign_of_time(spark):
    df = spark.createDataFrame([(0,), (1,), (-1,)], "ts bigint")
    got = [r[0] for r in df.select(iso_from_ms(F.col("ts"), "+00:00")).collect()]
    assert got == [
        "1970-01-01T00:00:00+00:00", "1970-01-01T00:00:00.001000+00:00", "1969-12-31T23:59:59.999000+00:00",
    ]


def test_validation_rules(spark):
    rows = [
        ("ok", 1, 1.0, 2.0, 0.5, 1.5, 0.0), ("null", 1, None, 2.0, 0.5, 1.5, 1.0),
        ("zero", 1, 0.0, 2.0, 0.5, 1.5, 1.0), ("cross", 1, 1.0, 0.4, 0.5, 1.5, 1.0),
        ("neg", 1, 1.0, 2.0, 0.5, 1.5, -1.0), ("nots", None, 1.0, 2.0, 0.5, 1.5, 1.0),
        (None, 1, 1.0, 2.0, 0.5, 1.5, 1.0),
    ]
    df = spark.createDataFrame(rows, BAR)
    assert [r.symbol for r in validate_bars(df).collect()] == ["ok"]
    v = rule_violations(df).head()
    assert (v.checked, v.open_null, v.open_not_positive, v.high_below_low, v.volume_negative) == (7, 1, 1, 1, 1)
    assert (v.ts_null, v.symbol_null) == (1, 1)


def test_dedup_keeps_last_arrival_and_is_stable(spark):
    rows = [("A", 1, 5.0, 9.0, 1.0, 5.0, 1.0, 1), ("A", 1, 2.0, 3.0, 1.0, 2.0, 7.0, 2), ("A", 2, 1.0, 1.0, 1.0, 1.0, 1.0, 3)]
    df = spark.createDataFrame(rows, BAR + ", seq int")
    for unique in (False, True):
        once = dedup_rows(df, ["symbol", "ts"], ["seq"], unique)
        assert sorted((r.ts, r.open, r.volume) for r in once.collect()) == [(1, 2.0, 7.0), (2, 1.0, 1.0)]
        assert once.columns == df.columns
        assert sorted(dedup_rows(once, ["symbol", "ts"], ["seq"], unique).collect()) == sorted(once.collect())
    assert {r.open for r in validate_bars(df, latest=("seq",)).collect()} == {1.0, 2.0}
    assert validate_bars(df, dedup=False).count() == 3
    with pytest.raises(ValueError):
        dedup_rows(df, ["symbol"], ["ts", "seq"], unique=True)


def test_local_days_around_clock_changes(spark):
    hours = lambda d: (lambda b: (b[1] - b[0]) / 3_600_000)(local_day_bounds_ms(d))
    assert (hours("2025-03-30"), hours("2025-10-26"), hours("2025-06-01")) == (23, 25, 24)
    stamps = ["2025-10-25T21:59:59+00:00", "2025-10-25T22:00:00+00:00", "2025-10-26T00:30:00+00:00",
              "2025-10-26T01:30:00+00:00", "2025-10-26T22:59:59+00:00", "2025-10-26T23:00:00+00:00"]
    rows = [("A", ms(s), float(i + 1), 9.0, 0.5, float(i + 1), 1.0) for i, s in enumerate(stamps)]
    df = spark.createDataFrame(rows, BAR)
    assert local_day_filter(df, "2025-10-26").count() == 4
    day = {str(r.day): r for r in bars_daily(df).collect()}
    # 00:30Z and 01:30Z are the same wall time; UTC order still finds open and close.
    assert (day["2025-10-26"].open, day["2025-10-26"].close, day["2025-10-26"].rows) == (2.0, 5.0, 4)
    assert day["2025-10-25"].rows == 1 and day["2025-10-27"].rows == 1


def test_daily_bars_count_repeated_bars_once(spark):
    rows = [("A", 0, 1.0, 1.0, 1.0, 1.0, 4.0, 0), ("A", 0, 2.0, 2.0, 2.0, 2.0, 5.0, 1), ("A", 60_000, 3.0, 3.0, 3.0, 3.0, 6.0, 2)]
    df = spark.createDataFrame(rows, BAR + ", seq int")
    kept = bars_daily(df, "UTC", dedup=True, latest=("seq",)).head()
    assert (kept.open, kept.volume, kept.rows) == (2.0, 11.0, 2)
    assert bars_daily(df, "UTC", order=("ts", "seq")).head().volume == 15.0


@pytest.mark.parametrize("interval", list(INTERVAL_SECONDS))
def test_resampling_brackets_open_and_close(spark, interval):
    rows = [("A", 1_700_000_000_000 + i * 37_000, 10.0 + i % 7, 20.0 + i % 5, 5.0 - i % 3, 11.0 + i % 4, 1.0) for i in range(500)]
    df = spark.createDataFrame(rows, BAR)
    out = resample_bars(df, interval).collect()
    width = interval_ms(interval)
    assert sum(r.rows for r in out) == 500 and len({r.ts for r in out}) == len(out)
    assert len(out) == len({r[1] // width for r in rows})
    assert all(r.ts % width == 0 and r.low <= min(r.open, r.close) and r.high >= max(r.open, r.close) for r in out)


@pytest.mark.parametrize("intervals", [tuple(INTERVAL_SECONDS), ("5m", "1h"), ("3m",), ("1m", "15m"), ("4h", "1d")])
def test_cascade_equals_each_width(spark, intervals):
    rows = [(s, -40_000_000 + i * 47_311, 10.0 + i % 7, 20.0 + i % 5, 5.0 - i % 3, None if i % 11 == 0 else 11.0 + i % 4, float(i % 3))
            for s in ("A", "B", None) for i in range(2500)]
    df = spark.createDataFrame([*rows, *rows[:50]], BAR)
    got = resample_cascade(df, intervals)
    for interval in intervals:
        want = resample_bars(df, interval)
        assert sorted(got.where(F.col("interval") == interval).select(want.columns).collect(), key=str) == sorted(want.collect(), key=str)
    assert resample_cascade(df.limit(0), intervals).count() == 0


def test_cascade_takes_the_input_through_one_exchange(spark):
    df = spark.range(100).selectExpr("string(id % 3) AS symbol", "id * 1000 AS ts", *[f"1.0D AS {c}" for c in ("open", "high", "low", "close", "volume")])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = resample_cascade(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    nodes = [line.lstrip(" :+-*()0123456789").split()[0] for line in plan.splitlines() if line.strip()]
    # ticks to narrow bars, narrow bars to blocks; the coarse widths use the latter again
    assert nodes.count("Exchange") == 2 and nodes.count("ReusedExchange") == 1, plan
    with pytest.raises(ValueError):
        resample_cascade(df, ("6h", "4h"))
    with pytest.raises(ValueError):
        resample_cascade(df, ())


def test_unknown_interval_and_missing_columns(spark):
    with pytest.raises(ValueError):
        interval_ms("7m")
    with pytest.raises(ValueError, match="close"):
        require_columns(spark.range(1), ["id", "close"])


def test_month_batches_are_clamped(spark):
    got = [(r.year, r.month, str(r.batch_start), str(r.batch_end))
           for r in month_batches(spark, "2024-11-15", "2025-02-03").orderBy("batch_start").collect()]
    assert got == [
        (2024, 11, "2024-11-15", "2024-11-30"), (2024, 12, "2024-12-01", "2024-12-31"),
        (2025, 1, "2025-01-01", "2025-01-31"), (2025, 2, "2025-02-01", "2025-02-03"),
    ]
    assert month_batches(spark, "2024-11-15", "2024-11-15").count() == 1
    with pytest.raises(ValueError):
        month_batches(spark, "2025-01-02", "2025-01-01")


def test_range_includes_the_whole_last_day(spark):
    stamps = ["2025-01-01T00:00:00+00:00", "2025-01-02T23:59:59+00:00", "2025-01-03T00:00:00+00:00", "2024-12-31T23:59:59+00:00"]
    df = spark.createDataFrame([(ms(s),) for s in stamps], "ts bigint")
    assert bars_in_range(df, "2025-01-01", "2025-01-02").count() == 2


def test_api_pages_give_bars_and_rejects(spark):
    good = '[1700000000000,"1.5","2","1","1.75","10",1700000059999,"0",3,"0","0","0"]'
    bodies = {
        "plain": f"[{good},{good.replace('1700000000000', '1700000060000')}]", "empty": "[]", "numbers": "[[1700000000000,1.5,2,1,1.75,10]]",
        "short": f'[{good},[1700000000000,"1.5"],null,["x","1","1","1","1","1"],[1700000000000,"1","1","1","1","n/a"]]',
        "error": '{"code":-1121,"msg":"Invalid symbol."}', "cut": f"[{good},[17000", "null": None, "text": "oops", "blank": "",
        "late": f"[{good.replace('1700000000000', '1800000000000')}]",
    }
    pages = spark.createDataFrame([(k, "A", "1m", v) for k, v in bodies.items()], "page string, symbol string, interval string, body string")
    bars = api_page_bars(pages, "2024-01-01", keep=("page",)).collect()
    assert sorted((r.page, r.ts) for r in bars) == [
        ("numbers", 1_700_000_000_000), ("plain", 1_700_000_000_000), ("plain", 1_700_000_060_000), ("short", 1_700_000_000_000)
    ]
    assert {(r.open, r.high, r.low, r.close, r.volume) for r in bars} == {(1.5, 2.0, 1.0, 1.75, 10.0)}
    rejects = {(r.page, r.entry, r.reason) for r in api_page_rejects(pages, keep=("page",)).collect()}
    assert rejects == {
        ("short", 1, "bad_values"), ("short", 2, "bad_open_time"), ("short", 3, "bad_open_time"), ("short", 4, "bad_values"),
        *[(page, None, "bad_page") for page in ("error", "cut", "null", "text", "blank")],
    }
    assert api_page_bars(pages).where("ts > 1750000000000").count() == 1
    assert api_page_bars(pages.limit(0)).count() == 0 == api_page_rejects(pages.limit(0)).count()
