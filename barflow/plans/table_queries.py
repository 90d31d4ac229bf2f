"""Queries that go through a sink and a source, in batch and as a stream.

Tables are written to fresh paths below the shared folder and read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from barflow.operators.bars import bars_daily
from barflow.operators.klines import validate_bars
from barflow.operators.returns import log_returns
from barflow.plans.bar_queries import BERLIN_DAY, VALID
from barflow.plans.event_queries import POST_EVENTS_SQL, vowel_model
from barflow.plans.inputs import (
    BARS,
    CLOSES,
    MINUTE_BARS,
    PAYLOAD_SQL,
    RELEASES,
    TICKS,
    as_bars,
    as_envelopes,
    as_ticks,
    bars,
    closes,
    envelopes,
    minute_bars,
    posts,
    releases,
    rounded,
    table,
    text_dates,
    tick_bars,
    with_payload,
)
from barflow.plans.jobs import (
    forecast_job,
    gold_day_bars,
    macro_job,
    macro_sentiment_job,
    posts_job,
    silver_job,
)
from barflow.plans.registry import query
from barflow.session import scratch_path
from barflow.sinks.files import (
    csv_append,
    write_gold,
    write_month,
    write_raw,
    write_silver,
)
from barflow.sources.archive import archive_files, archive_klines, load_archives
from barflow.sources.files import (
    bar_csv_scan,
    close_csv_scan,
    event_csv_scan,
    forecast_scan,
    gold_scan,
    raw_scan,
    scored_post_scan,
    silver_scan,
)
from barflow.sources.kafka import envelope_project
from barflow.streaming.bars import file_stream, start_files, stream_bars, stream_dedup, stream_latest, stream_raw
from barflow.streaming.merge import revised_scan, start_merge

_MONTHS = "interval STRING, symbol STRING, month STRING"
_DAY_TEXT = f"strftime({BERLIN_DAY}, '%Y-%m-%d')"

_RAW_SQL = f"""WITH {BARS} SELECT event_id % 3 AS partition, event_id // 3 AS "offset",
       symbol AS key, {_DAY_TEXT} AS date, {PAYLOAD_SQL} FROM bars"""


def _raw_shown(df):
    return text_dates(with_payload(df, "partition", "offset", "key", "date"), "date")


@query(_RAW_SQL)
def raw_lake(spark, sf_dir):
    path = scratch_path(spark, "raw")
    write_raw(envelope_project(envelopes(spark, sf_dir)), path)
    return _raw_shown(raw_scan(spark, path))


@query(f"""WITH {BARS}, day AS (SELECT *, {BERLIN_DAY} AS d FROM bars), last_arrival AS (
  SELECT * FROM day WHERE d = DATE '2024-01-15'
  QUALIFY row_number() OVER (PARTITION BY symbol, ts ORDER BY event_id DESC) = 1)
SELECT '2024-01-15' AS day, symbol, arg_min(open, ts) AS open, max(high) AS high, min(low) AS low,
       arg_max(close, ts) AS close, sum(volume) AS volume, count(*) AS rows
FROM last_arrival GROUP BY symbol""")
def raw_day_candles(spark, sf_dir):
    path = scratch_path(spark, "raw-json")
    write_raw(envelope_project(envelopes(spark, sf_dir), "UTC"), path, fmt="json")
    return text_dates(gold_day_bars(spark, path, "2024-01-15", fmt="json"), "day")


_GOLD_SQL = f"""WITH {TICKS} SELECT {_DAY_TEXT} AS day, symbol,
       arg_min(price, (ts, event_id)) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, (ts, event_id)) AS close, sum(volume) AS volume, count(*) AS rows
FROM ticks GROUP BY 1, 2"""


@query(_GOLD_SQL)
def gold_table(spark, sf_dir):
    path = scratch_path(spark, "gold")
    candles = bars_daily(tick_bars(spark, sf_dir), order=("ts", "event_id"))
    for _ in range(2):  # a re-run replaces its partitions
        write_gold(candles, path)
    return text_dates(gold_scan(spark, path), "day")


@query(f"""WITH {TICKS} SELECT 'gold' AS sink, count(*) AS rows
FROM (SELECT DISTINCT {BERLIN_DAY} AS d, symbol FROM ticks)""")
def rows_reported(spark, sf_dir):
    candles = bars_daily(tick_bars(spark, sf_dir), order=("ts", "event_id"))
    rows = write_gold(candles, scratch_path(spark, "gold"))
    return spark.range(1).select(F.lit("gold").alias("sink"), F.lit(rows).cast("bigint").alias("rows"))


_SILVER_COLUMNS = """symbol, ts AS open_ms, open, high, low, close, volume,
       strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS date,
       CAST(year(make_timestamp(ts * 1000)) AS INTEGER) AS year,
       CAST(month(make_timestamp(ts * 1000)) AS INTEGER) AS month"""


def _silver_shown(spark, path, interval=False):
    df = silver_scan(spark, path, interval=interval).withColumn("open_ms", F.unix_millis("open_ts"))
    return text_dates(df.drop("open_ts"), "date")


@query(f"""WITH {MINUTE_BARS}, ok AS (SELECT * FROM minute_bars WHERE {VALID}
  QUALIFY row_number() OVER (PARTITION BY symbol, ts ORDER BY event_id DESC) = 1)
SELECT {_SILVER_COLUMNS} FROM ok""")
def silver_table(spark, sf_dir):
    path = scratch_path(spark, "silver")
    write_silver(validate_bars(minute_bars(spark, sf_dir), latest=("event_id",)), path)
    return _silver_shown(spark, path)


@query(f"""WITH {BARS} SELECT ts, iso_ts, symbol, interval, open, high, low, close, volume,
       strftime(make_timestamp(ts * 1000), '%Y-%m') AS month FROM bars""")
def month_files(spark, sf_dir):
    path = scratch_path(spark, "months")
    write_month(bars(spark, sf_dir), path)
    return bar_csv_scan(spark, path, _MONTHS)


@query(f"""WITH {BARS}, ok AS (SELECT * FROM bars
  WHERE {VALID} AND ts >= 1704412800000 AND ts < 1706227200000
  QUALIFY row_number() OVER (PARTITION BY symbol, ts
    ORDER BY volume DESC, close DESC, open DESC, high DESC, low DESC) = 1)
SELECT '1m' AS interval, {_SILVER_COLUMNS} FROM ok""")
def silver_from_months(spark, sf_dir):
    raw, silver = scratch_path(spark, "months"), scratch_path(spark, "silver")
    write_month(bars(spark, sf_dir), raw)
    silver_job(spark, raw, silver, "2024-01-05", "2024-01-25", interval="1m")
    return _silver_shown(spark, silver, interval=True)


@query(f"""WITH {BARS}, widths AS (
  SELECT * FROM bars UNION ALL
  SELECT * REPLACE (ts - ts % 14400000 AS ts, '4h' AS interval) FROM bars), ok AS (
  SELECT * FROM widths WHERE {VALID} AND ts >= 1704412800000 AND ts < 1706227200000
  QUALIFY row_number() OVER (PARTITION BY interval, symbol, ts
    ORDER BY volume DESC, close DESC, open DESC, high DESC, low DESC) = 1)
SELECT interval, {_SILVER_COLUMNS} FROM ok""")
def silver_two_loads(spark, sf_dir):
    """Two widths, and a month in two loads of which one runs again."""
    raw, silver = scratch_path(spark, "months"), scratch_path(spark, "silver")
    minute = bars(spark, sf_dir)
    start = F.col("ts") - F.pmod("ts", F.lit(14_400_000))
    write_month(minute.unionByName(minute.withColumns({"ts": start, "interval": F.lit("4h")})), raw)
    for first, last in (("2024-01-05", "2024-01-15"), ("2024-01-16", "2024-01-25"), ("2024-01-05", "2024-01-15")):
        for interval in ("1m", "4h"):
            silver_job(spark, raw, silver, first, last, interval=interval)
    return _silver_shown(spark, silver, interval=True)


def _zipper():
    """Makes the function that zips one block of bars; made here so that it ships by value."""

    def zipped(pdf):
        import io
        import zipfile

        import pandas as pd

        symbol, block = pdf["symbol"].iloc[0], int(pdf["block"].iloc[0])
        columns = ["ts", "open", "high", "low", "close", "volume"]
        text = pdf[columns].to_csv(index=False, header=False)
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("bars.csv", "open_time,open,high,low,close,volume\n" + text)
        path = f"/archive/{block}/{symbol}-1m-2024-01.zip"
        return pd.DataFrame({"path": [path], "content": [buffer.getvalue()]})

    return zipped


@query(f"""WITH {BARS} SELECT ts, iso_ts, symbol, interval, open, high, low, close, volume FROM bars""")
def archive_bars(spark, sf_dir):
    # Blocks of 2,000 ids bound the rows of an archive however large the table is.
    blocks = bars(spark, sf_dir).withColumn("block", F.expr("event_id div 2000"))
    files = blocks.groupBy("symbol", "block").applyInPandas(
        _zipper(), "path string, content binary"
    )
    return archive_klines(files)


def _file_writer(base):
    """Makes the function that zips blocks of bars into files below ``base``, with some that must be refused.

    Each block gives one good archive; every block that 5 divides also gives one that breaks off and one whose
    name says nothing. Writing the same file again replaces it, so a task may run twice.
    """

    def write(pdf):
        import io
        import zipfile

        import pandas as pd
        from pyarrow import fs

        symbol, block = pdf["symbol"].iloc[0], int(pdf["block"].iloc[0])
        lines = pdf.sort_values("event_id")[["ts", "open_text", "high", "low", "close", "volume"]]
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("bars.csv", "open_time,open,high,low,close,volume\n" + lines.to_csv(index=False, header=False))
        content = buffer.getvalue()
        files = {f"{symbol}-1m-2024-01.zip": content}
        if block % 5 == 0:
            files |= {f"{symbol}-1m-2024-02.zip": content[: len(content) // 2], "notes.zip": content}
        store, root = fs.FileSystem.from_uri(base) if "://" in base or base.startswith("file:") else (fs.LocalFileSystem(), base)
        folder = f"{root}/{block}/{symbol}"
        store.create_dir(folder, recursive=True)
        for name, data in files.items():
            with store.open_output_stream(f"{folder}/{name}") as out:
                out.write(data)
        return pd.DataFrame({"files": [len(files)]})

    return write


def _archive_load(spark, sf_dir):
    """Zip files written by the tasks and read back; one open price in 89 is no number."""
    base = scratch_path(spark, "zips")
    is_bad = F.col("event_id") % 89 == 0
    blocks = bars(spark, sf_dir).select(
        "event_id", "symbol", "ts", "high", "low", "close", "volume",
        F.when(is_bad, "n/a").otherwise(F.col("open").cast("string")).alias("open_text"),
        F.expr("event_id div 2000").alias("block"),
    )
    blocks.groupBy("symbol", "block").applyInPandas(_file_writer(base), "files int").agg(F.sum("files")).collect()
    return load_archives(archive_files(spark, base))


@query(f"""WITH {BARS} SELECT ts, iso_ts, symbol, interval, open, high, low, close, volume FROM bars
WHERE event_id % 89 <> 0""")
def archive_file_bars(spark, sf_dir):
    return _archive_load(spark, sf_dir).bars


@query(f"""WITH {BARS}, files AS (SELECT DISTINCT event_id // 2000 AS block, symbol FROM bars)
SELECT block || '/' || symbol || '/' || symbol || '-1m-2024-02.zip' AS file, 'bad_archive' AS reason
FROM files WHERE block % 5 = 0 UNION ALL
SELECT block || '/' || symbol || '/notes.zip', 'bad_name' FROM files WHERE block % 5 = 0""")
def archive_file_faults(spark, sf_dir):
    faults = _archive_load(spark, sf_dir).faults
    return faults.select(F.regexp_extract("path", "([^/]+/[^/]+/[^/]+)$", 1).alias("file"), "reason")


@query(f"""WITH {BARS}, placed AS (
  SELECT *, row_number() OVER (PARTITION BY event_id // 2000, symbol ORDER BY event_id) AS line_no FROM bars)
SELECT (event_id // 2000) || '/' || symbol || '/' || symbol || '-1m-2024-01.zip' AS file, line_no,
       'bad_values' AS reason FROM placed WHERE event_id % 89 = 0""")
def archive_file_rejects(spark, sf_dir):
    rejects = _archive_load(spark, sf_dir).rejects
    return rejects.select(F.regexp_extract("path", "([^/]+/[^/]+/[^/]+)$", 1).alias("file"), "line_no", "reason")


_PERIOD_SQL = f"""WITH {CLOSES}, target AS (
  SELECT CAST(unnest(generate_series(DATE '2001-07-20', DATE '2001-08-05', INTERVAL 1 DAY)) AS DATE) AS t),
history AS (
  SELECT symbol, t, ds, close, lag(close) OVER (PARTITION BY symbol, t ORDER BY ds) AS prev
  FROM closes, target WHERE ds < t), f AS (
  SELECT symbol, t AS ds, regr_intercept(close, prev) + regr_slope(close, prev) * arg_max(close, ds)
         AS y_hat FROM history GROUP BY symbol, t HAVING count(*) >= 10)
SELECT f.symbol, strftime(f.ds, '%Y-%m-%d') AS ds, round(y_hat, 4) AS y_hat_close,
       close AS actual_close, round(abs(y_hat - close), 4) AS abs_error,
       round(abs(y_hat - close) / close, 7) AS ape FROM f LEFT JOIN closes USING (symbol, ds)"""


@query(_PERIOD_SQL)
def forecast_files(spark, sf_dir):
    daily, out = scratch_path(spark, "daily"), scratch_path(spark, "forecast")
    text = closes(spark, sf_dir).select(
        F.date_format("ds", "yyyy-MM-dd'T'00:00:00'Z'").alias("iso_ts"), "symbol", "close", "ds"
    )
    csv_append(text, daily, ("iso_ts", "symbol", "close"))
    forecast_job(spark, daily, out, "2001-07-20", "2001-08-05")
    df = forecast_scan(spark, out).drop("created_at")
    return rounded(rounded(text_dates(df, "ds"), 4, "y_hat_close", "abs_error"), 7, "ape")


_EVENT_LAKE_SQL = f"""WITH {RELEASES} SELECT 'macro_sentiment' AS source, event_type,
       strftime(event_date, '%Y-%m-%d') AS event_date, CAST(year(event_date) AS INTEGER) AS event_year,
       CAST(month(event_date) AS INTEGER) AS event_month, event_name, event_time_utc, actual, forecast,
       previous, units, period_month, local_time_str,
       event_type || '-' || strftime(event_date, '%Y-%m-%d') AS event_id,
       actual - previous AS event_delta,
       CASE WHEN actual > previous THEN -1 WHEN actual < previous THEN 1 ELSE 0 END
         AS event_sentiment FROM releases"""


@query(_EVENT_LAKE_SQL)
def event_lake(spark, sf_dir):
    lines, lake = scratch_path(spark, "releases"), scratch_path(spark, "events")
    releases(spark, sf_dir).write.json(lines)
    macro_job(spark, lines, lake)
    macro_sentiment_job(spark, lake)
    return text_dates(event_csv_scan(spark, lake, "macro_sentiment", sentiment=True), "event_date")


@query(_EVENT_LAKE_SQL)
def event_lake_two_loads(spark, sf_dir):
    """The months' events in two files, of which one is loaded again."""
    lake, all_lines = scratch_path(spark, "events"), releases(spark, sf_dir)
    odd = F.col("event_type") == "status_o"
    paths = [scratch_path(spark, "releases") for _ in range(2)]
    all_lines.where(odd).write.json(paths[0])
    all_lines.where(~odd).write.json(paths[1])
    for path in (*paths, paths[0]):
        macro_job(spark, path, lake)
        macro_sentiment_job(spark, lake)
    return text_dates(event_csv_scan(spark, lake, "macro_sentiment", sentiment=True), "event_date")


@query(POST_EVENTS_SQL)
def post_files(spark, sf_dir):
    return _post_files(spark, posts(spark, sf_dir), [F.lit(True)])


@query(POST_EVENTS_SQL)
def post_files_two_loads(spark, sf_dir):
    """The posts of every date in two loads."""
    even = F.col("post_id") % 120 < 60
    return _post_files(spark, posts(spark, sf_dir), [even, ~even])


def _post_files(spark, df, loads):
    out = scratch_path(spark, "post-events")
    for part in loads:
        lines = scratch_path(spark, "posts")
        df.where(part).select("date", "text", F.col("post_id").cast("string").alias("id")).write.json(lines)
        posts_job(spark, lines, out, vowel_model)
    shown = scored_post_scan(spark, out).withColumn("text_digest", F.md5("raw_text")).drop(
        "raw_text", "truth_id", "truth_url", "ingested_at"
    )
    return rounded(shown, 8, "sentiment_score")


@query("""WITH c AS (
  SELECT CAST(o_orderdate AS DATE) AS ds, arg_max(o_totalprice, o_orderkey) AS close
  FROM orders GROUP BY 1), r AS (SELECT ds, close / lag(close) OVER (ORDER BY ds) AS ratio FROM c)
SELECT 'ALL' AS symbol, strftime(ds, '%Y-%m-%d') AS ds, round(ln(ratio), 9) AS ret
FROM r WHERE ratio > 0""")
def close_csv_returns(spark, sf_dir):
    path = scratch_path(spark, "close")
    orders = table(spark, sf_dir, "orders")
    daily = orders.groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        F.max_by("o_totalprice", "o_orderkey").alias("close")
    )
    csv_append(daily, path, ("date", "close"))
    series = log_returns(close_csv_scan(spark, path, "ALL"))
    return rounded(text_dates(series, "ds"), 9, "ret")


# --- streams ----------------------------------------------------------------


def _event_stream(spark, sf_dir):
    # A pattern stands for one file as well as for a directory of files.
    path = f"{sf_dir}/events.parque[t]"
    return file_stream(spark, path, table(spark, sf_dir, "events").schema)


@query(_RAW_SQL)
def stream_raw_copy(spark, sf_dir):
    path, state = scratch_path(spark, "stream-raw"), scratch_path(spark, "state")
    stream = as_envelopes(as_bars(as_ticks(_event_stream(spark, sf_dir))))
    stream_raw(stream, path, state).awaitTermination()
    return _raw_shown(raw_scan(spark, path))


@query(f"""WITH {BARS}, rolled AS (
  SELECT symbol, ts - ts % 14400000 AS ts, '4h' AS interval,
         arg_min(open, (ts, event_id)) AS open, max(high) AS high, min(low) AS low,
         arg_max(close, (ts, event_id)) AS close, sum(volume) AS volume, count(*) AS rows
  FROM bars GROUP BY 1, 2)
SELECT * FROM rolled WHERE ts + 14400000 <= (SELECT max(ts) FROM bars) - 600000""")
def stream_bars_4h(spark, sf_dir):
    path, state = scratch_path(spark, "stream-bars"), scratch_path(spark, "state")
    stream = as_bars(as_ticks(_event_stream(spark, sf_dir)))
    rolled = stream_bars(stream, "4h", "10 minutes", ("ts", "event_id"))
    start_files(rolled, path, state).awaitTermination()
    return spark.read.schema(rolled.schema).parquet(path)


def _minute_stream(spark, sf_dir):
    stream = as_bars(as_ticks(_event_stream(spark, sf_dir)))
    return stream.withColumn("ts", F.col("ts") - F.pmod("ts", F.lit(60000)))


_LAST_ARRIVALS = f"""{MINUTE_BARS}, closed AS (SELECT max(ts) - 600000 AS mark FROM minute_bars),
arrivals AS (SELECT * FROM minute_bars
  QUALIFY row_number() OVER (PARTITION BY symbol, ts ORDER BY event_id DESC) = 1)"""


@query(f"""WITH {_LAST_ARRIVALS} SELECT event_id, ts, symbol, interval, open, high, low, close, volume
FROM arrivals, closed WHERE ts <= mark""")
def stream_distinct_bars(spark, sf_dir):
    """Of bars that arrive again and again, the last one, once no more can arrive."""
    path, state = scratch_path(spark, "stream-latest"), scratch_path(spark, "state")
    kept = stream_latest(_minute_stream(spark, sf_dir), ("event_id",)).drop("event_time", "iso_ts")
    start_files(kept, path, state).awaitTermination()
    return spark.read.schema(kept.schema).parquet(path)


@query(f"WITH {MINUTE_BARS} SELECT DISTINCT symbol, ts FROM minute_bars")
def stream_distinct_keys(spark, sf_dir):
    path, state = scratch_path(spark, "stream-dedup"), scratch_path(spark, "state")
    kept = stream_dedup(_minute_stream(spark, sf_dir)).select("symbol", "ts")
    start_files(kept, path, state).awaitTermination()
    return spark.read.schema(kept.schema).parquet(path)


@query(f"""WITH {_LAST_ARRIVALS}, rolled AS (
  SELECT symbol, ts - ts % 14400000 AS ts, '4h' AS interval,
         arg_min(open, ts) AS open, max(high) AS high, min(low) AS low,
         arg_max(close, ts) AS close, sum(volume) AS volume, count(*) AS rows
  FROM arrivals GROUP BY 1, 2)
SELECT rolled.* FROM rolled, closed WHERE ts + 14400000 <= mark""")
def stream_bars_dedup(spark, sf_dir):
    """The roll-up of last arrivals: two stateful steps in one stream."""
    path, state = scratch_path(spark, "stream-rolled"), scratch_path(spark, "state")
    latest = stream_latest(_minute_stream(spark, sf_dir), ("event_id",))
    rolled = stream_bars(latest, "4h", None)
    start_files(rolled, path, state).awaitTermination()
    return spark.read.schema(rolled.schema).parquet(path)


_REVISED_SQL = f"""WITH {MINUTE_BARS}, ok AS (SELECT * FROM minute_bars WHERE {VALID}
  QUALIFY row_number() OVER (PARTITION BY symbol, ts ORDER BY event_id DESC) = 1)
SELECT {_SILVER_COLUMNS}, event_id AS revision FROM ok"""


def _corrected(spark, sf_dir, checkpoints):
    """Half of the arrivals, then the other half, each in a run of its own; both hold older and newer ones."""
    drops, path = scratch_path(spark, "arrivals"), scratch_path(spark, "revised")
    arrivals = minute_bars(spark, sf_dir).drop("iso_ts")
    for rest, checkpoint in enumerate(checkpoints):
        if rest < 2:
            arrivals.where(F.col("event_id") % 2 == rest).write.mode("append").parquet(drops)
        stream = file_stream(spark, drops, arrivals.schema, maxFilesPerTrigger=8)
        start_merge(stream, path, checkpoint, "event_id").awaitTermination()
    shown = revised_scan(spark, path).withColumn("open_ms", F.unix_millis("open_ts"))
    return text_dates(shown.drop("open_ts"), "date")


@query(_REVISED_SQL)
def stream_corrections(spark, sf_dir):
    """Corrections that come in a later run than the bar, in any order."""
    state = scratch_path(spark, "state")
    return _corrected(spark, sf_dir, [state, state])


@query(_REVISED_SQL)
def stream_corrections_replayed(spark, sf_dir):
    """The same, and then everything once more under a new checkpoint."""
    state = scratch_path(spark, "state")
    return _corrected(spark, sf_dir, [state, state, scratch_path(spark, "state")])
