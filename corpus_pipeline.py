"""From raw documents to packed training sequences: five stages over the whole table.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; every stage
but the last returns the columns of documents. ``run`` writes each stage's rows to the shared folder.

Rows are judged one by one, also where they share an id or have none. Null texts fail the quality rules; empty tables pass through
every stage. SQL cannot express the near-duplicate and packing stages, so there is no oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.llm import decontaminate, linedup, neardup, packing, quality
from barflow.llm.common import SPACES, free_name, growing, release, stored, table, tables
from barflow.llm.queries import token_ranks


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the threshold table."""
    return quality.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines within two edits of an earlier line are taken out, short ones where they equal it; documents left without
    a word go."""
    left = linedup.dedup_lines(docs, linedup.Settings(exact_short=True))
    columns = [F.length("text").cast("bigint").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return left.where(F.length(F.btrim("text", F.lit(SPACES))) > 0).select(*columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least document of every group with 80 % of five-word shingles in common.

    Every row has a key of its own, so rows that share an id are judged apart and rows without one take part;
    of a group the row with the least id stays, one without an id only where none has one.
    """
    key = free_name(docs, "row_key")
    keyed = stored(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    groups = neardup.near_duplicates(keyed, neardup.Settings(words=5, percent=80, bands=40), id_column=key)
    placed = keyed.select(key, "doc_id").join(growing(groups.select(F.col("doc_id").alias(key), "component_id")), key)
    rank = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", key)
    first = placed.groupBy("component_id").agg(F.min(rank).alias("first")).select(F.col(f"first.{key}").alias(key))
    return keyed.join(growing(first), key, "left_semi").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is tiled."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, in sequences of 1024 tokens."""
    return packing.pack_documents(docs, *token_ranks())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with tables() as used:
            kept = stored(stage(spark, docs, sf_dir), name)
        release(docs, *[t for t in used if t is not kept])
        docs = kept
    return docs
