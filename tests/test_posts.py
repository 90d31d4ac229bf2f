import pytest
from pyspark.sql import functions as F

from barflow.functions.textcols import (
    economic_categories,
    is_economic,
    is_low_info,
    market_bias,
    polarity_index,
    polarity_label,
    polarity_score,
)
from barflow.operators.posts import (
    chunk_tokens,
    dedup_posts,
    normalize_posts,
    pool_sentiment,
    posts_since,
    score_chunks,
)
from barflow.plans.jobs import scored_posts
from barflow.schemas import SCORED_POST_SCHEMA

LOW_INFO = [
    (None, True), ("", True), (" \t\u00a0\n", True), ("https://example.com/a?b=c", True), ("www.example.com", True),
    ("example.com", True), ("HTTP://EXAMPLE.COM", True), ("http s://exa mple.com/x y", True),
    ("three little words", True), ("a b c d e", True), ("!!! ??? ... ,,,", True),
    ("@someone @anyone #hashtag #another tag", True),
    ("The treasury will publish the numbers tomorrow", False),
    ("The treasury will publish https://example.com/very/long/path", False),
    ("one two https://example.com/with/many/letters/in/the/path", True),
    ("four words@someone lengthy sufficiently characters", False),
    ("Les chiffres d\u00e9finitifs arrivent bient\u00f4t", False), ("\u0446\u0435\u043d\u044b \u043d\u0430 \u043d\u0435\u0444\u0442\u044c \u0441\u043d\u043e\u0432\u0430 \u0432\u044b\u0440\u043e\u0441\u043b\u0438", False),
    ("1234 5678 9012 3456 7890 1234 5678", True), ("under_score words_here count_as_one four", False),
    ("Hello.world", True), ("joined.up. this reads as one host name", True),
    ("trailing.dot, with some more letters here", False), ("a..b", True),
    ("#tag " * 4000, True), ("word " * 4000, False), ("x." * 20000, True), ("-" * 20000, True),
]


def test_low_info_cases(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LOW_INFO)], "id int, text string")
    got = {r.id: r.low for r in df.select("id", is_low_info(F.col("text")).alias("low")).collect()}
    wrong = [(LOW_INFO[i][0] or "")[:40] for i, low in got.items() if low != LOW_INFO[i][1]]
    assert wrong == []


def test_keywords_are_substrings(spark):
    rows = [("The FED moved", "macro", True), ("confederation", "macro", True), ("BTC and tariffs", "crypto,macro", True),
            ("nothing here", "other_econ", False), ("mining", "crypto", True)]
    df = spark.createDataFrame([(r[0],) for r in rows], "text string")
    got = df.select(F.concat_ws(",", economic_categories(F.col("text"))), is_economic(F.col("text"))).collect()
    assert [(r[0], r[1]) for r in got] == [(c, e) for _, c, e in rows]


def test_polarity_bounds(spark):
    df = spark.createDataFrame([(-0.3,), (-0.29,), (0.0,), (0.29,), (0.3,)], "s double")
    got = df.select(polarity_label(F.col("s")), polarity_index(F.col("s")), market_bias(polarity_index(F.col("s")))).collect()
    assert [tuple(r) for r in got] == [
        ("negative", -1, "bearish"), ("neutral", 0, "neutral"), ("neutral", 0, "neutral"),
        ("neutral", 0, "neutral"), ("positive", 1, "bullish"),
    ]
    zero = spark.range(1).select(polarity_score(F.lit(0.0), F.lit(0.0)), polarity_score(F.lit(3.0), F.lit(1.0))).head()
    assert tuple(zero) == (0.0, 0.5)


@pytest.mark.parametrize("n, chunks", [(1, 1), (512, 1), (513, 2), (960, 2), (961, 3), (5000, 12)])
def test_chunks_cover_the_whole_text(spark, n, chunks):
    words = [f"w{i}" for i in range(n)]
    out = chunk_tokens(spark.createDataFrame([(1, "  " + " ".join(words) + "\n")], "post_id int, text string"))
    rows = sorted(out.collect(), key=lambda r: r.chunk)
    assert len(rows) == chunks
    joined = rows[0].tokens + [t for r in rows[1:] for t in r.tokens[64:]]
    assert joined == words and rows[-1].tokens[-1] == words[-1]
    assert all(len(r.tokens) == 512 for r in rows[:-1])
    assert all(a.tokens[-64:] == b.tokens[:64] for a, b in zip(rows, rows[1:]))


def test_chunks_of_nothing_and_bad_overlap(spark):
    df = spark.createDataFrame([(1, "  "), (2, None)], "post_id int, text string")
    assert chunk_tokens(df).count() == 0
    with pytest.raises(ValueError):
        chunk_tokens(df, width=10, overlap=10)


def test_cleaning_dates_and_duplicates(spark):
    rows = [("2025-01-20T00:00:00Z", " hello "), ("2025-01-19T23:59:59+00:00", "old"), ("2025-01-19T23:00:00-05:00", "[Video]"),
            ("nonsense", "x"), (None, "y"), ("2025-03-01T10:00:00", "hello"), ("2025-03-01T10:00:00", "hello")]
    df = spark.createDataFrame(rows, "date string, text string")
    assert [r.text for r in normalize_posts(df).collect()].count("hello") == 3
    assert posts_since(df).count() == 4
    assert dedup_posts(df).count() == 6


def test_scored_posts_keep_every_copy(spark):
    text = "The Federal Reserve will decide on the interest rate tomorrow"
    rows = [("2025-02-01T10:00:00.250000+01:00", text)] * 3 + [("2025-02-02T10:00:00Z", text), ("2025-02-02T10:00:00Z", "rates up")]
    df = spark.createDataFrame(rows, "date string, text string")

    def model(column):
        return F.struct(F.lit(0.9).alias("positive"), F.lit(0.1).alias("negative"))

    out = scored_posts(df, model)
    assert out.columns == SCORED_POST_SCHEMA.fieldNames()
    got = out.collect()
    assert len(got) == 4 and {r.sentiment_label for r in got} == {"positive"}
    assert sorted({r.created_at for r in got}) == ["2025-02-01T09:00:00.250000+00:00", "2025-02-02T10:00:00+00:00"]
    assert all(r.economic_categories == "macro" and abs(r.sentiment_score - 0.8) < 1e-12 for r in got)


def test_pandas_model_runs_on_chunks(spark):
    import pandas as pd
    from pyspark.sql.types import StructType

    schema = StructType().add("positive", "double").add("negative", "double")

    def classify(texts):
        for batch in texts:
            share = batch.str.count("up") / batch.str.len()
            yield pd.DataFrame({"positive": share, "negative": share * 0})

    import typing

    classify.__annotations__ = {"texts": typing.Iterator[pd.Series], "return": typing.Iterator[pd.DataFrame]}
    chunks = chunk_tokens(spark.createDataFrame([(1, "up up down"), (2, "down")], "post_id int, text string"))
    pooled = {r.post_id: r for r in pool_sentiment(score_chunks(chunks, F.pandas_udf(classify, schema))).collect()}
    assert pooled[1].sentiment_score == 1.0 and pooled[2].sentiment_score == 0.0
