"""Search helpers: case folding, token sets, lookup terms."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from fettle.functions.nulls import strip

# Words that carry no meaning in a question about the reports.
STOP_WORDS = (
    "about",
    "after",
    "also",
    "and",
    "are",
    "can",
    "could",
    "data",
    "dataset",
    "does",
    "from",
    "have",
    "how",
    "into",
    "most",
    "report",
    "reports",
    "should",
    "that",
    "the",
    "their",
    "there",
    "these",
    "this",
    "values",
    "what",
    "when",
    "which",
    "with",
    "would",
)

# Token and lookup-term patterns, and upper-case words that are not lookups.
TOKEN_PATTERN = r"[A-Za-z0-9_]{3,}"
QUOTED_PATTERN = r"""["']([^"']{3,80})["']"""
REFERENCE_PATTERN = r"\b[A-Za-z0-9]+(?:[-/#][A-Za-z0-9]+){2,}\b"
ACRONYM_PATTERN = r"\b[A-Z][A-Z0-9&.-]{3,}\b"
NOT_LOOKUPS = ("ABOUT", "DATA", "DATASET", "REPORT", "REPORTS")

_UNICODE = "(?U)"  # word boundaries next to accented letters


def fold_case(c: Column) -> Column:
    """Case-insensitive form of text."""
    return F.lower(F.replace(c, F.lit("ß"), F.lit("ss")))


def fold_query(text: str) -> str:
    """The same form for a search term given by the caller."""
    return text.replace("ß", "ss").lower()


def any_contains(columns: Iterable[Column], term: str) -> Column:
    """True when any column contains the term, ignoring case."""
    term = fold_query(term)
    hits = [F.coalesce(fold_case(c).contains(term), F.lit(False)) for c in columns]
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def token_set(c: Column) -> Column:
    """Distinct lower-cased words without the stop words, in text order."""
    words = F.array_join(F.regexp_extract_all(c, F.lit(TOKEN_PATTERN), F.lit(0)), " ")
    # Lower case comes after the match: some other letters turn into ASCII ones.
    # array_except also removes repeats; text without words splits into one empty string.
    return F.array_except(
        F.split(F.lower(words), " "), F.split(F.lit(" ".join(("", *STOP_WORDS))), " ")
    )


def words_found(c: Column, words: Iterable[str]) -> Column:
    """How many of some lower-case words occur in text as whole words, ignoring case.

    Same as the size of the intersection with ``token_set``, without listing the words: a
    plain search rules most words out, only the others are checked for their edges.
    """
    edge, lowered = "[A-Za-z0-9_]", F.lower(c)
    found = F.lit(0)
    for word in words:
        whole = c.rlike(f"(?i)(?<!{edge}){word}(?!{edge})")
        found = found + F.when(lowered.contains(word), whole.cast("int")).otherwise(0)
    return found


def lookup_term(c: Column) -> Column:
    """The exact term a question asks about, else the empty string.

    A quoted phrase wins, then a reference number, then the longest upper-case word
    (the earliest at equal length).
    """
    quoted = F.regexp_extract(c, QUOTED_PATTERN, 1)
    reference = F.regexp_extract(c, _UNICODE + REFERENCE_PATTERN, 0)
    acronyms = F.filter(
        F.regexp_extract_all(c, F.lit(_UNICODE + ACRONYM_PATTERN), F.lit(0)),
        lambda t: ~t.isin(list(NOT_LOOKUPS)),
    )
    longest = F.aggregate(
        acronyms,
        F.lit(""),
        lambda best, t: F.when(F.char_length(t) > F.char_length(best), t).otherwise(best),
    )
    return F.when(quoted != "", strip(quoted)).when(reference != "", reference).otherwise(longest)
