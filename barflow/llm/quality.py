"""Quality rules: a threshold table compiled into one projection of built-in functions.

Every measure is a column expression over the words and lines of the whole text; the rules are rows
of a table (measure, lower and upper bound) that ``verdict`` turns into one boolean expression. No
user function, no shuffle: one pass over the documents.

Defined results: a null or empty text has no words and fails ``base``; repeated rows are judged one
by one and stay; other columns pass through untouched, and a column named like a measure is only
hidden from the measuring, never overwritten, in ``keep_good``; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.functions.once import with_computed
from barflow.llm.common import SPACE_CLASS, SPACES, free_name, text_or_empty

#: Common function words of the four languages.
STOP_WORDS = (
    "the of and to in is that for it was on are as with be by this from at or an not have but "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine auch es "
    "de la le et les un du une que est pour qui dans par sur pas au plus "
    "el en y los se las por con no su al lo como"
).split()
SYMBOLS = "#*$%&|<>"
WINDOW = 8  # doubled up from single words


@dataclass(frozen=True)
class Rule:
    """Keep a text whose measure lies in [low, high]; an open bound is None."""

    measure: str
    low: float | None = None
    high: float | None = None


#: Ratios: per word, but dup_line_ratio per line. A ratio of nothing is 0.
RULES = (
    Rule("n_words", low=20),
    Rule("mean_word_chars", low=2.0, high=12.0),
    Rule("symbol_ratio", high=0.3),
    Rule("stop_word_ratio", low=0.05),
    Rule("dup_line_ratio", high=0.5),
)


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """One boolean column: every rule of the table holds."""
    held = F.lit(True)
    for rule in rules:
        if rule.low is not None:
            held = held & (F.col(rule.measure) >= F.lit(rule.low))
        if rule.high is not None:
            held = held & (F.col(rule.measure) <= F.lit(rule.high))
    return held


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def _doubled(parts: str, span: int, n: Column) -> Column:
    """Hashes of windows of 2 * span words, by position, from windows of span words (or the words)."""
    pairs = F.transform(
        F.slice(parts, F.lit(1), n - (2 * span - 1)), lambda x, i: F.xxhash64(x, F.get(F.col(parts), i + span))
    )
    return F.when(n >= 2 * span, pairs).otherwise(F.array().cast("array<bigint>"))


def _repeated(windows: Column) -> Column:
    """Positions, in order, of the windows found twice or more. Equal hashes are neighbours once sorted."""
    in_order = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def found_again(sorted_windows: Column) -> Column:
        same = lambda x, k: F.get(sorted_windows, k)["h"] == x["h"]
        twice = F.filter(
            sorted_windows,
            lambda x, k: F.coalesce(same(x, k - 1), F.lit(False)) | F.coalesce(same(x, k + 1), F.lit(False)),
        )
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    # a lambda over a one-element array binds the sorted array, which is then built once
    return F.get(F.transform(F.array(in_order), found_again), F.lit(0))


def _covered(positions: Column) -> Column:
    """Number of words that lie in a window starting at one of the ascending positions."""
    start = F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(-WINDOW).alias("last"))
    step = lambda acc, p: F.struct(
        (acc["total"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("total"), p.alias("last")
    )
    return F.aggregate(positions, start, step, lambda acc: acc["total"])


def measures(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and every measure of the text."""
    body = text_or_empty("body")
    n = F.col("n")
    has_word = lambda line: F.length(F.btrim(line, F.lit(SPACES))) > 0
    is_stop = lambda word: F.lower(word).isin(STOP_WORDS)
    counts = ["n_symbols", "word_chars", "n_lines", "n_dup_lines", "n_stop_words", "n"]
    counted = (
        docs.select(*keep, text_or_empty(text).alias("body"))
        .select(
            *keep,
            F.length(F.regexp_replace(body, f"[^{SYMBOLS}]+", "")).cast("bigint").alias("n_symbols"),
            F.array_remove(F.split(body, f"{SPACE_CLASS}+"), "").alias("words"),
            F.filter(F.split(body, "\n"), has_word).alias("lines"),
        )
        .select(
            *keep, "n_symbols",
            F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
            F.size("lines").cast("bigint").alias("n_lines"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
            F.size(F.filter("words", is_stop)).cast("bigint").alias("n_stop_words"),
            F.size("words").alias("n"),
            "words",
        )
        .select(*keep, *counts, _doubled("words", 1, n).alias("h2"))
        .select(*keep, *counts, _doubled("h2", 2, n).alias("h4"))
        .select(*keep, *counts, _doubled("h4", 4, n).alias("windows"))
    )
    repeats = F.when(F.size(F.array_distinct("windows")) < F.size("windows"), _covered(_repeated(F.col("windows"))))
    return counted.select(
        *keep,
        F.col("n").cast("bigint").alias("n_words"),
        "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words",
        F.coalesce(repeats, F.lit(0)).cast("bigint").alias("n_repeat_words"),
    ).select(
        "*",
        _share("word_chars", "n_words").alias("mean_word_chars"),
        _share("n_symbols", "n_words").alias("symbol_ratio"),
        _share("n_stop_words", "n_words").alias("stop_word_ratio"),
        _share("n_dup_lines", "n_lines").alias("dup_line_ratio"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judge(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
          rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measures with ``base_failed`` and ``kept``."""
    return measures(docs, text, keep).select(
        "*", base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept")
    )


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass, with all their columns."""
    row, kept = "row", free_name(docs, "kept")
    packed = docs.select(F.struct("*").alias(row), F.col(text).alias("measured_text"))
    judged = judge(packed, "measured_text", (row,), rules)
    # behind a generator the filter is not copied below the measuring
    once = with_computed(judged.select(row, F.col("kept").alias("verdict")), {kept: F.col("verdict")})
    return once.filter(F.col(kept)).select(f"{row}.*")
