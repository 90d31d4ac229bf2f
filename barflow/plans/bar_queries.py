"""Queries over ticks, bars and message envelopes."""

from __future__ import annotations

from pyspark.sql import functions as F

from barflow.constants import INTERVAL_SECONDS, LOCAL_ZONE
from barflow.operators.bars import (
    bars_daily,
    batch_counters,
    forecast_calendar,
    latest_bar,
    latest_value,
    next_day,
    resample_bars,
    resample_cascade,
    tail_n,
    union_symbols,
)
from barflow.operators.klines import (
    api_page_bars,
    api_page_rejects,
    bars_in_range,
    decode_payload,
    enrich_bars,
    enrich_ticks,
    is_valid_bar,
    kline_rejects,
    local_day_filter,
    parse_kline_rows,
    rule_violations,
    split_months,
    stored_range,
    symbol_filter,
    validate_bars,
    with_month,
    with_month_key,
)
from barflow.plans.inputs import (
    BARS,
    CLOSES,
    MINUTE_BARS,
    PAYLOAD_SQL,
    RETURNS,
    TICKS,
    as_bars,
    as_envelopes,
    as_ticks,
    bars,
    closes,
    envelopes,
    minute_bars,
    returns,
    rounded,
    table,
    text_dates,
    tick_bars,
    ticks,
    with_payload,
)
from barflow.plans.registry import query
from barflow.sinks.kafka import kafka_encode
from barflow.sources.kafka import envelope_project, kafka_envelope_day, offsets_by_time

BERLIN_DAY = (
    "CAST((make_timestamp(ts * 1000) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin' AS DATE)"
)
_DAY_TEXT = f"strftime({BERLIN_DAY}, '%Y-%m-%d')"


@query(f"""WITH {TICKS}
SELECT {_DAY_TEXT} AS day, symbol,
       arg_min(price, (ts, event_id)) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, (ts, event_id)) AS close, sum(volume) AS volume, count(*) AS rows
FROM ticks GROUP BY 1, 2""")
def daily_bars_berlin(spark, sf_dir):
    return text_dates(bars_daily(tick_bars(spark, sf_dir), order=("ts", "event_id")), "day")


@query(f"""WITH {MINUTE_BARS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, ts ORDER BY event_id DESC) AS rn
  FROM minute_bars)
SELECT {_DAY_TEXT} AS day, symbol, arg_min(open, ts) AS open, max(high) AS high,
       min(low) AS low, arg_max(close, ts) AS close, sum(volume) AS volume, count(*) AS rows
FROM ranked WHERE rn = 1 GROUP BY 1, 2""")
def daily_bars_dedup(spark, sf_dir):
    candles = bars_daily(minute_bars(spark, sf_dir), dedup=True, latest=("event_id",), unique=True)
    return text_dates(candles, "day")


def _resample_sql(interval: str, ms: int) -> str:
    return f"""WITH {TICKS}
SELECT symbol, ts - ts % {ms} AS ts, '{interval}' AS interval,
       arg_min(price, (ts, event_id)) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, (ts, event_id)) AS close, sum(volume) AS volume, count(*) AS rows
FROM ticks GROUP BY 1, 2"""


@query(_resample_sql("4h", 14_400_000))
def resample_4h(spark, sf_dir):
    return resample_bars(tick_bars(spark, sf_dir), "4h", ("ts", "event_id"))


@query(_resample_sql("15m", 900_000))
def resample_15m(spark, sf_dir):
    return resample_bars(tick_bars(spark, sf_dir), "15m", ("ts", "event_id"))


_ALL_WIDTHS = ", ".join(f"('{name}', {1000 * seconds})" for name, seconds in INTERVAL_SECONDS.items())


@query(f"""WITH {TICKS}
SELECT symbol, ts - ts % ms AS ts, interval,
       arg_min(price, (ts, event_id)) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, (ts, event_id)) AS close, round(sum(volume), 6) AS volume, count(*) AS rows
FROM ticks CROSS JOIN (VALUES {_ALL_WIDTHS}) w(interval, ms) GROUP BY symbol, ts - ts % ms, interval""")
def resample_all_widths(spark, sf_dir):
    """Bars of all eleven widths from one exchange of the ticks."""
    bars = resample_cascade(tick_bars(spark, sf_dir), order=("ts", "event_id"))
    return rounded(bars, 6, "volume").withColumn("rows", F.col("rows").cast("bigint"))


@query(_resample_sql("1d", 86_400_000))
def resample_1d(spark, sf_dir):
    return resample_bars(tick_bars(spark, sf_dir), "1d", ("ts", "event_id"))


@query(f"""WITH {BARS} SELECT event_id % 3 AS partition, event_id // 3 AS "offset", ts, iso_ts,
       symbol, interval, open, high, low, close, volume FROM bars""")
def decode_payload_bars(spark, sf_dir):
    decoded = decode_payload(envelopes(spark, sf_dir), keep=("partition", "offset"))
    return decoded.withColumn("partition", F.col("partition").cast("bigint"))


@query(f"""WITH {BARS}, local AS (SELECT *, {BERLIN_DAY} AS d FROM bars)
SELECT event_id, ts, symbol, close FROM local WHERE d = DATE '2024-01-15'""")
def local_day_rows(spark, sf_dir):
    events = stored_range(table(spark, sf_dir, "events"), "ts", "2024-01-15", "2024-01-15", LOCAL_ZONE)
    day = local_day_filter(as_bars(as_ticks(events)), "2024-01-15")
    return day.select("event_id", "ts", "symbol", "close")


@query(f"""WITH {BARS} SELECT event_id, strftime({BERLIN_DAY}, '%Y-%m-%d') AS date,
       symbol AS key, {PAYLOAD_SQL} FROM bars""")
def envelope_dates(spark, sf_dir):
    out = envelope_project(envelopes(spark, sf_dir))
    event_id = F.col("offset") * 3 + F.col("partition")
    return text_dates(with_payload(out.withColumn("event_id", event_id), "event_id", "date", "key"), "date")


@query(f"""WITH {BARS} SELECT event_id % 3 AS partition, event_id // 3 AS "offset", symbol AS key,
       '2024-01-20' AS date, {PAYLOAD_SQL} FROM bars WHERE {BERLIN_DAY} = DATE '2024-01-20'""")
def kafka_day(spark, sf_dir):
    events = stored_range(table(spark, sf_dir, "events"), "ts", "2024-01-20", "2024-01-20", LOCAL_ZONE)
    out = kafka_envelope_day(as_envelopes(as_bars(as_ticks(events))), "2024-01-20")
    return text_dates(with_payload(out, "partition", "offset", "key", "date"), "date")


@query(f"""WITH {TICKS}, m AS (SELECT event_id % 3 AS p, event_id // 3 AS o, ts FROM ticks),
b AS (SELECT 1705273200000 AS s, 1705359600000 AS e), f AS (
  SELECT p, coalesce(min(o) FILTER (WHERE ts >= s), max(o) + 1) AS start_offset,
         coalesce(min(o) FILTER (WHERE ts >= e), max(o) + 1) AS end_offset
  FROM m, b GROUP BY p)
SELECT 'topic_0' AS topic, p AS partition, start_offset,
       greatest(start_offset, end_offset) AS end_offset FROM f""")
def kafka_day_offsets(spark, sf_dir):
    found = offsets_by_time(envelopes(spark, sf_dir), "2024-01-15")
    return found.withColumn("partition", F.col("partition").cast("bigint"))


@query(f"""WITH {TICKS} SELECT event_id, symbol AS key,
       CAST(to_json({{'symbol': symbol, 'ts': ts, 'event_id': event_id, 'price': price,
                 'volume': volume}}) AS VARCHAR) AS value FROM ticks""")
def kafka_key_value(spark, sf_dir):
    messages = kafka_encode(ticks(spark, sf_dir))
    event_id = F.get_json_object("value", "$.event_id").cast("bigint")
    return messages.select(event_id.alias("event_id"), "key", "value")


def _archive_text(spark, sf_dir):
    """Archive-like text rows: mixed time units and some unreadable ones."""
    i = F.col("event_id")
    t = F.col("ts").cast("string")
    open_time = (
        F.when(i % 17 == 0, F.concat(F.lit("t"), t))
        .when(i % 19 == 0, F.lit("1000"))
        .when(i % 3 == 0, F.concat(t, F.lit("321")))
        .otherwise(t)
    )
    text = {c: F.col(c).cast("string") for c in ("open", "high", "low", "close")}
    volume = F.when(i % 23 == 0, "n/a").otherwise(F.col("volume").cast("string"))
    return (
        bars(spark, sf_dir)
        .withColumns({**text, "volume": volume, "open_time": open_time})
        .select("event_id", "open_time", "open", "high", "low", "close", "volume", "symbol", "interval")
    )


@query(f"""WITH {BARS} SELECT event_id, ts, iso_ts, symbol, interval, open, high, low, close, volume
FROM bars WHERE event_id % 17 <> 0 AND event_id % 19 <> 0 AND event_id % 23 <> 0""")
def parse_kline_text(spark, sf_dir):
    return parse_kline_rows(_archive_text(spark, sf_dir), keep=("event_id",))


@query(f"""WITH {BARS}, r AS (
  SELECT symbol, CASE WHEN event_id % 17 = 0 THEN 'bad_open_time'
              WHEN event_id % 19 = 0 THEN 'out_of_range'
              WHEN event_id % 23 = 0 THEN 'bad_values' END AS reason FROM bars)
SELECT symbol, reason, count(*) AS rows FROM r WHERE reason IS NOT NULL GROUP BY 1, 2""")
def kline_reject_counts(spark, sf_dir):
    rejects = kline_rejects(_archive_text(spark, sf_dir))
    return rejects.groupBy("symbol", "reason").agg(F.count(F.lit(1)).alias("rows"))


_PAGE = 40  # bars a page


def _api_pages(spark, sf_dir):
    """Pages of up to forty bars of a symbol as an exchange sends them; every ninth one is cut off."""
    quote = lambda c: F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"'))
    values = F.concat_ws(",", "open_time", *[quote(c) for c in ("open", "high", "low", "close", "volume")], F.lit('0,"0"'))
    page = F.expr(f"event_id div {_PAGE}")
    rows = _archive_text(spark, sf_dir).withColumn("open_time", F.when(F.col("open_time").startswith("t"), F.concat(F.lit('"'), "open_time", F.lit('"'))).otherwise(F.col("open_time")))
    entry = F.struct("event_id", F.concat(F.lit("["), values, F.lit("]")).alias("text"))
    listed = F.array_join(F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["text"]), ",")
    body = F.when(F.col("page") % 9 == 0, F.concat(F.lit("["), listed, F.lit(',[17'))).otherwise(F.concat(F.lit("["), listed, F.lit("]")))
    return rows.withColumn("page", page).groupBy("symbol", "interval", "page").agg(body.alias("body"))


_PAGED = f"""{BARS}, paged AS (
  SELECT *, event_id // {_PAGE} AS page, CASE WHEN event_id // {_PAGE} % 9 = 0 THEN 'bad_page' WHEN event_id % 17 = 0 THEN 'bad_open_time'
         WHEN event_id % 19 = 0 THEN 'out_of_range' WHEN event_id % 23 = 0 THEN 'bad_values' END AS reason FROM bars)"""


@query(f"""WITH {_PAGED} SELECT page, ts, iso_ts, symbol, interval, open, high, low, close, volume
FROM paged WHERE reason IS NULL AND ts < 1705795200000""")
def api_pages_to_bars(spark, sf_dir):
    return api_page_bars(_api_pages(spark, sf_dir), "2024-01-20", keep=("page",))


@query(f"""WITH {_PAGED} SELECT symbol, reason, count(DISTINCT CASE WHEN reason = 'bad_page' THEN page ELSE event_id END) AS rows
FROM paged WHERE reason IS NOT NULL GROUP BY 1, 2""")
def api_page_reject_counts(spark, sf_dir):
    rejects = api_page_rejects(_api_pages(spark, sf_dir), keep=("page",))
    return rejects.groupBy("symbol", "reason").agg(F.count(F.lit(1)).alias("rows"))


@query(f"""WITH {BARS} SELECT event_id, ts, symbol, close FROM bars
WHERE ts >= 1704844800000 AND ts < 1705795200000""")
def bars_in_date_range(spark, sf_dir):
    events = stored_range(table(spark, sf_dir, "events"), "ts", "2024-01-10", "2024-01-20")
    kept = bars_in_range(as_bars(as_ticks(events)), "2024-01-10", "2024-01-20")
    return kept.select("event_id", "ts", "symbol", "close")


VALID = """open > 0 AND high > 0 AND low > 0 AND close > 0 AND high >= low AND volume >= 0"""


@query(f"""WITH {MINUTE_BARS}, ok AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, ts ORDER BY event_id DESC) AS rn
  FROM minute_bars WHERE {VALID})
SELECT symbol, ts AS open_ms, open, high, low, close, volume,
       strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS date,
       CAST(year(make_timestamp(ts * 1000)) AS INTEGER) AS year,
       CAST(month(make_timestamp(ts * 1000)) AS INTEGER) AS month
FROM ok WHERE rn = 1""")
def valid_bars(spark, sf_dir):
    valid = with_month(validate_bars(minute_bars(spark, sf_dir), latest=("event_id",), unique=True))
    return text_dates(
        valid.withColumn("open_ms", F.unix_millis("open_ts")).drop("open_ts"), "date"
    )


@query(f"""WITH {BARS} SELECT symbol, count(*) AS checked,
       count(*) FILTER (WHERE symbol IS NULL) AS symbol_null,
       count(*) FILTER (WHERE ts IS NULL) AS ts_null,
       count(*) FILTER (WHERE open IS NULL) AS open_null,
       count(*) FILTER (WHERE high IS NULL) AS high_null,
       count(*) FILTER (WHERE low IS NULL) AS low_null,
       count(*) FILTER (WHERE close IS NULL) AS close_null,
       count(*) FILTER (WHERE volume IS NULL) AS volume_null,
       count(*) FILTER (WHERE open <= 0) AS open_not_positive,
       count(*) FILTER (WHERE high <= 0) AS high_not_positive,
       count(*) FILTER (WHERE low <= 0) AS low_not_positive,
       count(*) FILTER (WHERE close <= 0) AS close_not_positive,
       count(*) FILTER (WHERE high < low) AS high_below_low,
       count(*) FILTER (WHERE volume < 0) AS volume_negative
FROM bars GROUP BY symbol""")
def rule_violation_counts(spark, sf_dir):
    return rule_violations(bars(spark, sf_dir), by=("symbol",))


@query(f"""WITH {CLOSES}, span AS (
  SELECT symbol, min(ds) AS s, max(ds) AS e FROM closes GROUP BY 1), m AS (
  SELECT symbol, s, e, CAST(unnest(generate_series(date_trunc('month', s), e, INTERVAL 1 MONTH))
         AS DATE) AS month FROM span)
SELECT symbol, CAST(year(month) AS INTEGER) AS year, CAST(month(month) AS INTEGER) AS month,
       strftime(greatest(s, month), '%Y-%m-%d') AS batch_start,
       strftime(least(e, last_day(month)), '%Y-%m-%d') AS batch_end FROM m""")
def month_splits(spark, sf_dir):
    span = closes(spark, sf_dir).groupBy("symbol").agg(
        F.min("ds").alias("s"), F.max("ds").alias("e")
    )
    return text_dates(split_months(span, "s", "e").drop("s", "e"), "batch_start", "batch_end")


@query(f"""WITH {BARS} SELECT symbol, strftime(make_timestamp(ts * 1000), '%Y-%m') AS month,
       count(*) AS rows FROM bars GROUP BY 1, 2""")
def month_keys(spark, sf_dir):
    keyed = with_month_key(bars(spark, sf_dir))
    return keyed.groupBy("symbol", "month").agg(F.count(F.lit(1)).alias("rows"))


@query(f"""WITH {TICKS} SELECT event_id, symbol, price FROM ticks
WHERE symbol IN ('click', 'purchase')""")
def symbols_listed(spark, sf_dir):
    kept = symbol_filter(ticks(spark, sf_dir), ["click", "purchase"])
    return kept.select("event_id", "symbol", "price")


@query(f"""WITH {TICKS}, busy AS (
  SELECT symbol FROM ticks GROUP BY 1 HAVING avg(price) > 50)
SELECT event_id, symbol, price FROM ticks WHERE symbol IN (SELECT symbol FROM busy)""")
def symbols_from_table(spark, sf_dir):
    t = ticks(spark, sf_dir)
    busy = t.groupBy("symbol").agg(F.avg("price").alias("a")).where(F.col("a") > 50)
    return symbol_filter(t, busy).select("event_id", "symbol", "price")


@query(f"""WITH {BARS} SELECT b.event_id, b.ts, replace(iso_ts, 'Z', '+00:00') AS iso_ts, b.symbol,
       t.price, 'ticker' AS event_type, 'binance' AS source
FROM bars b JOIN ticks t USING (event_id)""")
def ticks_enriched(spark, sf_dir):
    t = ticks(spark, sf_dir)
    tagged = enrich_ticks(t.withColumn("symbol", F.struct("symbol", "event_id")))
    return tagged.select(
        F.col("symbol.event_id").alias("event_id"),
        "ts",
        "iso_ts",
        F.col("symbol.symbol").alias("symbol"),
        "price",
        "event_type",
        "source",
    )


@query(f"""WITH {BARS} SELECT ts, symbol, interval, open, high, low, close, volume,
       replace(iso_ts, 'Z', '+00:00') AS iso_ts, 'kline' AS event_type, 'binance' AS source
FROM bars""")
def bars_enriched(spark, sf_dir):
    return enrich_bars(bars(spark, sf_dir))


@query(f"""WITH {BARS} SELECT symbol, arg_max(ts, (ts, event_id)) AS ts,
       arg_max(event_id, (ts, event_id)) AS event_id, arg_max(open, (ts, event_id)) AS open,
       arg_max(close, (ts, event_id)) AS close, arg_max(volume, (ts, event_id)) AS volume
FROM bars GROUP BY 1""")
def latest_bars(spark, sf_dir):
    newest = latest_bar(bars(spark, sf_dir), ("ts", "event_id"))
    return newest.select("symbol", "ts", "event_id", "open", "close", "volume")


@query(f"""WITH {CLOSES} SELECT symbol, arg_max(close, ds) AS close FROM closes GROUP BY 1""")
def latest_closes(spark, sf_dir):
    return latest_value(closes(spark, sf_dir), "close")


@query(f"""WITH {RETURNS}, r AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ds DESC) AS rn FROM returns)
SELECT symbol, strftime(ds, '%Y-%m-%d') AS ds, round(ret, 9) AS ret FROM r WHERE rn <= 250""")
def tail_250(spark, sf_dir):
    return rounded(text_dates(tail_n(returns(spark, sf_dir)), "ds"), 9, "ret")


@query(f"""WITH {CLOSES}
SELECT symbol, strftime(max(ds) + 1, '%Y-%m-%d') AS ds FROM closes GROUP BY 1""")
def next_days(spark, sf_dir):
    return text_dates(next_day(closes(spark, sf_dir)), "ds")


@query(f"""WITH {CLOSES}, l AS (SELECT symbol, max(ds) AS d FROM closes GROUP BY 1)
SELECT symbol, CAST(step AS INTEGER) AS step, strftime(d + CAST(step AS INTEGER), '%Y-%m-%d') AS ds
FROM l, range(1, 15) t(step)""")
def forecast_days(spark, sf_dir):
    return text_dates(forecast_calendar(closes(spark, sf_dir), 14), "ds")


@query(f"""WITH {CLOSES} SELECT symbol, strftime(ds, '%Y-%m-%d') AS ds, close FROM closes""")
def last_close_daily(spark, sf_dir):
    return text_dates(closes(spark, sf_dir), "ds")


def _order_prices(spark, sf_dir):
    from barflow.plans.inputs import table

    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("symbol"),
        F.col("o_orderdate").cast("date").alias("ds"),
        F.col("o_totalprice").alias("close"),
        "o_orderkey",
    )


@query("""SELECT o_orderpriority AS symbol, strftime(o_orderdate, '%Y-%m-%d') AS ds,
       arg_min(o_totalprice, o_orderkey) AS close FROM orders GROUP BY 1, 2""")
def first_per_date(spark, sf_dir):
    from barflow.operators.bars import dedup_dates

    first = dedup_dates(_order_prices(spark, sf_dir), "close", "first", ("o_orderkey",))
    return text_dates(first, "ds")


@query("""SELECT o_orderpriority AS symbol, strftime(o_orderdate, '%Y-%m-%d') AS ds,
       arg_max(o_totalprice, o_orderkey) AS close FROM orders GROUP BY 1, 2""")
def last_per_date(spark, sf_dir):
    from barflow.operators.bars import dedup_dates

    last = dedup_dates(_order_prices(spark, sf_dir), "close", "last", ("o_orderkey",))
    return text_dates(last, "ds")


@query(f"""WITH {BARS} SELECT symbol, count(*) AS attempted, count(*) FILTER (WHERE {VALID}) AS ok,
       count(*) FILTER (WHERE NOT ({VALID})) AS fail FROM bars GROUP BY 1""")
def batch_counts(spark, sf_dir):
    return batch_counters(bars(spark, sf_dir), is_valid_bar())


@query(f"""WITH {TICKS}, {CLOSES}
SELECT symbol, price, event_id, NULL AS close FROM ticks
UNION ALL SELECT symbol, NULL, NULL, close FROM closes""")
def symbols_united(spark, sf_dir):
    t = ticks(spark, sf_dir).select("symbol", "price", "event_id")
    return union_symbols([t, closes(spark, sf_dir).select("symbol", "close")])
