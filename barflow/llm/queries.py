"""The registered training-data queries, their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from barflow.llm import (
    alignment, decontaminate, htmltext, licenses, linedup, neardup, packing, quality, sharding, substrings, suffixtree, topk, whitening,
)
from barflow.llm.common import table, unsigned_crc32
from barflow.llm.sql import LICENSE_SQL, NEAR_SQL, QUALITY_SQL, TOP_K_SQL


def token_ranks() -> tuple[str, str]:
    """Vocabulary file and split pattern: the ids of the tokenizer byte_bpe_50k.json."""
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query()
def op1_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of nearly equal bytes; equal texts stay together."""
    return sharding.assign_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("size"), "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return htmltext.extract(table(spark, sf_dir, "pages"))


@query(LICENSE_SQL)
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences whose notices are in each document, and how many notices there are."""
    return licenses.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", F.size("matches").cast("bigint").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"]))), ",").alias("licenses"),
    )


@query()
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines within two edits of an earlier line are taken out, short ones if equal; what is left of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linedup.dedup_lines(docs, linedup.Settings(exact_short=True)).select(
        "doc_id", F.size(F.split("text", "\n", -1)).cast("bigint").alias("n_lines_left"),
        F.size("places_removed").cast("bigint").alias("n_removed"), "places_removed",
        unsigned_crc32(F.col("text")).alias("text_crc32"),
    )


@query(NEAR_SQL)
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets overlap by 85 % or more."""
    settings = neardup.Settings(words=3, percent=85, bands=30)
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), settings)


@query()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, *token_ranks())


@query()
def op7_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of all texts, learned from six sevenths of them."""
    return suffixtree.score_texts(table(spark, sf_dir, "documents"))


@query(QUALITY_SQL)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, symbols, repeats and the verdict of the threshold table for every document."""
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query()
def op9_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated 400-byte strings."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


@query()
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items whose tiles cover 60 % of their words, for every document."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two public tokenizers over every text."""
    ranks, pattern = token_ranks()
    return alignment.align(table(spark, sf_dir, "documents"), ranks, pattern, public_tokenizers.path("piece_bpe_32k.model"), 32_000)


@query(TOP_K_SQL)
def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one, by integer inner product."""
    return topk.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the eight leading components, whitened."""
    # a deviation that does not fit a long is null here; the operator gives 38 digits
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
