"""Text posts: cleaning, filtering, token chunks, scoring and the event record."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.constants import (
    CHUNK_OVERLAP,
    CHUNK_TOKENS,
    CRYPTO_KEYWORDS,
    MACRO_KEYWORDS,
    POST_EVENT_TYPE,
    POST_LANGUAGE,
    POST_PLACEHOLDERS,
    POST_PLATFORM,
    POST_USER_HANDLE,
    POSTS_SINCE,
)
from barflow.functions.checks import require_columns
from barflow.functions.textcols import (
    BLANK,
    category_list,
    contains_any,
    economic_categories,
    is_economic,
    is_low_info,
    market_bias,
    polarity_index,
    polarity_label,
    polarity_score,
    strip,
)


def normalize_posts(df: DataFrame, text: str = "text") -> DataFrame:
    """Trim the text; drop empty posts and media placeholders."""
    return df.withColumn(text, strip(F.col(text))).where(
        (F.length(text) > 0) & ~F.col(text).isin(*POST_PLACEHOLDERS)
    )


def posts_since(df: DataFrame, since: str = POSTS_SINCE, date: str = "date") -> DataFrame:
    """Posts from ``since`` on, with ``created_at`` in UTC; unreadable dates are dropped.

    Dates without a zone are UTC, whatever the session's zone is.
    """
    text = F.trim(F.col(date))
    zoned = F.rlike(text, F.lit("([A-Za-z]|[+-][0-9]{2}:?[0-9]{2})$"))
    day_only = F.rlike(text, F.lit("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"))
    utc = F.when(day_only, F.concat(text, F.lit("T00:00:00Z"))).when(zoned, text).otherwise(F.concat(text, F.lit("Z")))
    return df.withColumn("created_at", F.try_to_timestamp(utc)).where(
        F.col("created_at") >= F.lit(since).cast("timestamp")
    )


def dedup_posts(df: DataFrame, keys: Sequence[str] = ("date", "text")) -> DataFrame:
    """One row per date and text; copies collapse before the shuffle.

    Every other column keeps its smallest value, so the result is the same on every run.
    """
    others = [F.min(c).alias(c) for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    return df.groupBy(*keys).agg(*others).select(*df.columns)


def classify_posts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``low_info``, ``is_economic`` and ``economic_categories`` to every post."""
    flags = {
        "_crypto": F.coalesce(contains_any(F.col(text), CRYPTO_KEYWORDS), F.lit(False)),
        "_macro": F.coalesce(contains_any(F.col(text), MACRO_KEYWORDS), F.lit(False)),
    }
    return (
        df.withColumns(flags)
        .withColumns(
            {
                "low_info": is_low_info(F.col(text)),
                "is_economic": F.col("_crypto") | F.col("_macro"),
                "economic_categories": category_list(F.col("_crypto"), F.col("_macro")),
            }
        )
        .drop("_crypto", "_macro")
    )


def economic_posts(df: DataFrame, text: str = "text") -> DataFrame:
    """Posts that say something and mention a keyword; the cheap keyword test runs first."""
    kept = df.where(is_economic(F.col(text))).where(~is_low_info(F.col(text)))
    return kept.withColumns(
        {"is_economic": F.lit(True), "economic_categories": economic_categories(F.col(text))}
    )


def chunk_tokens(
    df: DataFrame,
    text: str = "text",
    width: int = CHUNK_TOKENS,
    overlap: int = CHUNK_OVERLAP,
    keep: Sequence[str] = ("post_id",),
) -> DataFrame:
    """Overlapping runs of ``width`` blank-separated tokens, covering the whole text.

    Consecutive chunks share ``overlap`` tokens and the last one ends with the text. Each row
    carries its own tokens only, never the whole post.
    """
    if not 0 <= overlap < width:
        raise ValueError("overlap must be at least 0 and below width")
    step = width - overlap
    tokens = F.split(strip(F.col(text)), rf"[{BLANK}]+")
    last = F.greatest(F.ceil((F.size("_tokens") - width) / step), F.lit(0)).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.slice(F.col("_tokens"), i * step + 1, F.lit(width)),
    )
    return (
        df.where(F.length(strip(F.col(text))) > 0)
        .select(*keep, tokens.alias("_tokens"))
        .select(*keep, pieces.alias("_pieces"))
        # There is always a first piece. The outer form spares the emptiness filter that would
        # be inferred below, with the splitting copied into it.
        .select(*keep, F.posexplode_outer("_pieces").alias("chunk", "tokens"))
    )


def score_chunks(chunks: DataFrame, model: Callable[[Column], Column]) -> DataFrame:
    """Class probabilities per chunk.

    ``model`` maps the chunk text to a struct with ``positive`` and ``negative``: an iterator
    pandas UDF around any classifier, loaded once per worker, or a plain expression.
    """
    return chunks.withColumn("_p", model(F.concat_ws(" ", "tokens"))).select(
        *[c for c in chunks.columns if c != "tokens"],
        F.col("_p.positive").alias("p_pos"),
        F.col("_p.negative").alias("p_neg"),
    )


def pool_sentiment(
    scored: DataFrame, by: Sequence[str] = ("post_id",), carry: Sequence[str] = ()
) -> DataFrame:
    """Mean chunk probabilities per post, and the score, label, index and bias they give.

    ``carry`` names columns that one chunk of a post holds and the others leave null.
    """
    require_columns(scored, ["p_pos", "p_neg", *by, *carry])
    pooled = scored.groupBy(*by).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in carry],
        F.count(F.lit(1)).alias("chunks"),
        F.avg("p_pos").alias("p_pos"),
        F.avg("p_neg").alias("p_neg"),
    )
    return with_polarity(
        pooled.withColumn("sentiment_score", polarity_score(F.col("p_pos"), F.col("p_neg")))
    )


def with_polarity(df: DataFrame, score: str = "sentiment_score") -> DataFrame:
    index = polarity_index(F.col(score))
    return df.withColumns(
        {
            "sentiment_label": polarity_label(F.col(score)),
            "sentiment_index": index.cast("int"),
            "market_bias": market_bias(index),
        }
    )


def post_record(
    df: DataFrame,
    text: str = "text",
    event_type: str = POST_EVENT_TYPE,
    platform: str = POST_PLATFORM,
    user_handle: str = POST_USER_HANDLE,
    language: str = POST_LANGUAGE,
    ingested_at: Column | None = None,
) -> DataFrame:
    """The 16-column event of a scored post, as it is written out."""
    iso = "yyyy-MM-dd'T'HH:mm:ss"

    def utc(at: Column) -> Column:
        micros = F.date_format(at, ".SSSSSS")
        fraction = F.when(micros == ".000000", "").otherwise(micros)
        return F.concat(F.date_format(at, iso), fraction, F.lit("+00:00"))

    now = ingested_at if ingested_at is not None else F.current_timestamp()
    return df.select(
        F.lit(event_type).alias("event_type"),
        F.lit(platform).alias("platform"),
        F.lit(user_handle).alias("user_handle"),
        (F.col("truth_id") if "truth_id" in df.columns else F.lit(None).cast("string")).alias("truth_id"),
        F.lit(None).cast("string").alias("truth_url"),
        utc(F.col("created_at")).alias("created_at"),
        F.date_format("created_at", "yyyy-MM-dd").alias("event_date"),
        F.col(text).alias("raw_text"),
        F.lit(language).alias("language"),
        "is_economic",
        F.concat_ws(",", "economic_categories").alias("economic_categories"),
        "sentiment_score",
        "sentiment_label",
        "sentiment_index",
        "market_bias",
        utc(now).alias("ingested_at"),
    )
