"""Similarity of two names on a 0-100 scale, and the decision it leads to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fettle.functions.text import bind, compact_text


def _chars(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit("(?s)(.)"), F.lit(1))


def common_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two short strings."""

    def walk(other: Column) -> Column:
        def step(best: Column, char: Column) -> Column:
            # best[j]: longest match against the first j+1 characters of the other string.
            gained = F.transform(
                other,
                lambda o, j: F.when(
                    o == char, F.when(j > 0, F.get(best, j - 1)).otherwise(F.lit(0)) + 1
                ).otherwise(F.get(best, j)),
            )
            return bind(
                gained,
                lambda g: F.transform(g, lambda _, j: F.array_max(F.slice(g, F.lit(1), j + 1))),
            )

        start = F.array_repeat(F.lit(0), F.size(other))
        return F.aggregate(_chars(a), start, step, lambda best: F.array_max(best))

    return F.coalesce(bind(_chars(b), walk), F.lit(0))


def _pair(a: Column, b: Column) -> Column:
    return F.struct(a.alias("a"), b.alias("b"))


def _windows(short: Column, long: Column) -> Column:
    """Pairs of the short text and each window of the long text.

    Windows have the length of the short text and may hang over either end.
    """
    width, one = F.char_length(short), F.lit(1)
    return F.transform(
        F.sequence(F.lit(2) - width, F.char_length(long)),
        lambda s: _pair(
            short,
            F.substr(long, F.greatest(s, one), width - F.greatest(one - s, F.lit(0))),
        ),
    )


def _percent(pair: Column) -> Column:
    """Twice the common subsequence over the total length, in percent."""
    total = F.char_length(pair["a"]) + F.char_length(pair["b"])
    return F.lit(200.0) * common_length(pair["a"], pair["b"]) / total


def ratios(a: Column, b: Column) -> Column:
    """Struct of the whole ratio and the best ratio of the shorter text in the longer.

    At equal length each text is tried in the other.
    """
    la, lb = F.char_length(a), F.char_length(b)
    forward, backward = _windows(a, b), _windows(b, a)
    windows = (
        F.when(la < lb, forward)
        .when(la > lb, backward)
        .otherwise(F.concat(forward, backward))
    )
    every = F.transform(F.concat(F.array(_pair(a, b)), windows), _percent)
    return bind(
        every,
        lambda r: F.struct(
            r[0].alias("whole"), F.array_max(F.slice(r, 2, F.size(r) - 1)).alias("partial")
        ),
    )


def compact_similarity(a: Column, b: Column) -> Column:
    """Mean of both ratios of two compact texts, rounded half to even; 0 if one is empty."""
    mean = bind(ratios(a, b), lambda r: F.bround((r["whole"] + r["partial"]) / 2, 0))
    return F.when((a == "") | (b == ""), F.lit(0)).otherwise(mean.cast("int"))


def similarity(a: Column, b: Column) -> Column:
    """Similarity of two raw names on their compact forms."""
    return bind(
        compact_text(a), lambda x: bind(compact_text(b), lambda y: compact_similarity(x, y))
    )


def repeat_similarity(k: Column, j: Column) -> Column:
    """The same score when both texts repeat one key, k and j times.

    One text then contains the other, so the window match is 100 and the common
    subsequence is the shorter text.
    """
    share = F.lit(200.0) * F.least(k, j) / (k + j)
    return F.bround((share + 100) / 2, 0).cast("int")


def decision(score: Column, hi: int = 95, lo: int = 80) -> Column:
    """Accept, review or reject by score."""
    return (
        F.when(score >= hi, F.lit("accepted"))
        .when(score >= lo, F.lit("review"))
        .otherwise(F.lit("rejected"))
    )
