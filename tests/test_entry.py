import duckdb
import pytest

import __spark_entry__ as entry_module
import compare

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "daily_bars_berlin", "daily_bars_dedup", "decode_payload_bars", "valid_bars", "kafka_day_offsets",
    "macro_flat", "event_impact_post3", "posts_low_info", "token_chunks", "describe_return_series",
    "ar1_walk_forward_series", "tail_risk_30d", "stream_bars_4h", "event_lake",
]


def test_every_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert len(entry_module.queries()) > 90


def test_entry_gives_candles(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["day", "symbol", "open", "high", "low", "close", "volume", "rows"] and df.count() > 0


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in compare.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", SAMPLE)
def test_queries_match_their_sql(spark, con, name):
    text, _, ok = compare.compare(spark, con, SF, name, entry_module.queries()[name], entry_module.oracle_sql()[name])
    assert ok, text
