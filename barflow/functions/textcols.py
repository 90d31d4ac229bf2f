"""Text rules as column expressions.

The character classes are spelled out, so that letters, digits and blanks mean the same in
every script whatever the default of the regex engine. Groups repeat a fixed, small number of
times, so that a text of any length is matched without deep recursion.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from barflow.constants import (
    CRYPTO_KEYWORDS,
    MACRO_KEYWORDS,
    MIN_LETTERS,
    MIN_WORDS,
    NEGATIVE_AT_MOST,
    POSITIVE_AT_LEAST,
)

# Blanks as Unicode sees them: as a character class, and one by one for trimming.
BLANK = r"\s\x0B\x1c-\x1f\x85\p{Z}"
BLANKS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WORD = r"\p{L}\p{N}_"
HOST = "A-Za-z0-9-"

# Up to the first slash only characters a link may have; ordinary text fails here early.
_LINK_LIKE = rf"^[{HOST}.:{BLANK}]*(?:/|\z)"
# A host with dots inside, none doubled or at an end, and an optional path.
_LINK = r"(?i)^(?:https?://)?(?=[^/]*\.)(?![^/]*\.\.)[a-z0-9-][a-z0-9.-]*(?<!\.)(?:/.*)?$"

# Each pattern starts where a word starts.
_SCHEME = rf"(?i)h(?<![{WORD}]h)ttps?://[{BLANK}]*"
_WWW = rf"(?i)w(?<![{WORD}]w)ww\.[{BLANK}]*"
_DOMAIN = (
    rf"(?:[A-Za-z0-9](?<![{WORD}].)|-(?<=[{WORD}]-))[{HOST}]*\.[{HOST}][^{BLANK}]*"
)


def strip(text: Column) -> Column:
    """Text without leading and trailing blanks of any kind."""
    return F.btrim(text, F.lit(BLANKS))


def is_url_only(text: Column) -> Column:
    """True when the text, blanks removed, is one host name with an optional path."""
    collapsed = F.regexp_replace(text, rf"[{BLANK}]+", "")
    return F.rlike(text, F.lit(_LINK_LIKE)) & F.rlike(collapsed, F.lit(_LINK))


def without_links(text: Column) -> Column:
    """Text with links turned into blanks.

    A pattern runs only on texts that hold the characters it cannot do without.
    """
    t = F.when(F.contains(text, F.lit("://")), F.regexp_replace(text, _SCHEME, " ")).otherwise(text)
    t = F.when(F.rlike(text, F.lit(r"(?i)www\.")), F.regexp_replace(t, _WWW, " ")).otherwise(t)
    dotted = F.rlike(text, F.lit(rf"\.[{HOST}]"))
    return F.when(dotted, F.regexp_replace(t, _DOMAIN, " ")).otherwise(t)


def is_low_info(
    text: Column, min_words: int = MIN_WORDS, min_letters: int = MIN_LETTERS
) -> Column:
    """Empty, only a link, or too few words or letters once links and tags are gone.

    Words are runs of letters, digits and underscores; the counting stops when both limits are
    reached. Texts without ``@`` and ``#`` hold no tags that would have to be cut out first.
    """
    words = rf"(?=^(?:[^{WORD}]*+[{WORD}]++){{{min_words}}})"
    letters = rf"(?=^(?:[^\p{{L}}]*+\p{{L}}){{{min_letters}}})"
    enough = F.lit(f"^{words}{letters}")
    plain = without_links(text)
    tagged = F.rlike(text, F.lit("[@#]"))
    untagged = F.regexp_replace(plain, rf"[@#][{WORD}]+", " ")
    return (
        text.isNull()
        | is_url_only(text)
        | ~F.when(tagged, F.rlike(untagged, enough)).otherwise(F.rlike(plain, enough))
    )


def contains_any(text: Column, keywords: Sequence[str]) -> Column:
    """True when any keyword is a substring of the lower-cased text.

    A keyword that contains another one can never decide the result and is not tested. The
    one-element array makes the lower-cased text a variable, so it is computed once.
    """
    needed = [k for k in keywords if not any(o != k and o in k for o in keywords)]

    def found(lowered: Column) -> Column:
        tests = [F.contains(lowered, F.lit(k)) for k in needed]
        return reduce(lambda a, b: a | b, tests)

    return F.exists(F.array(F.lower(text)), found)


def category_list(crypto: Column, macro: Column) -> Column:
    """Array of ``crypto`` and ``macro``, or ``other_econ`` when neither applies."""
    names = (("crypto", crypto), ("macro", macro))
    found = F.array_compact(F.array(*[F.when(flag, F.lit(name)) for name, flag in names]))
    return F.when(crypto | macro, found).otherwise(F.array(F.lit("other_econ")))


def economic_categories(
    text: Column,
    crypto: Sequence[str] = CRYPTO_KEYWORDS,
    macro: Sequence[str] = MACRO_KEYWORDS,
) -> Column:
    """The category list of a text."""
    return category_list(contains_any(text, crypto), contains_any(text, macro))


def is_economic(
    text: Column,
    crypto: Sequence[str] = CRYPTO_KEYWORDS,
    macro: Sequence[str] = MACRO_KEYWORDS,
) -> Column:
    return contains_any(text, [*crypto, *macro])


def polarity_index(
    score: Column, low: float = NEGATIVE_AT_MOST, high: float = POSITIVE_AT_LEAST
) -> Column:
    return F.when(score <= low, -1).when(score >= high, 1).otherwise(0)


def polarity_label(
    score: Column, low: float = NEGATIVE_AT_MOST, high: float = POSITIVE_AT_LEAST
) -> Column:
    return F.when(score <= low, "negative").when(score >= high, "positive").otherwise("neutral")


def market_bias(index: Column) -> Column:
    return F.when(index > 0, "bullish").when(index < 0, "bearish").otherwise("neutral")


def polarity_score(positive: Column, negative: Column) -> Column:
    """``(p − n) / (p + n)``, or 0 when both are 0."""
    total = positive + negative
    return F.when(total > 0, (positive - negative) / total).otherwise(0.0)
