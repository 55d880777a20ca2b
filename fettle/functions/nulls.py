"""Missing-value rules for text columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that counts as null when a text table is read (exact, not trimmed).
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# The code points that Unicode text trimming treats as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _may_start_blank(c: Column) -> Column:
    """False only if text starts with a visible character.

    In byte order white space lies below "!" or from U+0085 up: two comparisons settle
    almost every cell without a trim.
    """
    return (c < "!") | (c >= "\x85")


def strip(c: Column) -> Column:
    """Remove leading and trailing Unicode white space."""
    edge = _may_start_blank(c) | _may_start_blank(F.substring(c, -1, 1))
    return F.when(edge, F.btrim(c, F.lit(WHITESPACE))).otherwise(c)


def is_blank(c: Column) -> Column:
    """True for text made of white space only (and for the empty string)."""
    # The trim stops at the first visible character.
    return _may_start_blank(c) & (F.ltrim(c, F.lit(WHITESPACE)) == "")


def is_na_token(c: Column, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """True when the whole cell equals one of the null tokens."""
    tokens = list(tokens)
    if not tokens:
        return F.lit(False)
    # One constant instead of one literal per token keeps wide plans small.
    known = F.split(F.lit("\n".join(tokens)), "\n")
    # The byte length is stored with the string: long cells are never compared.
    longest = max(len(t.encode()) for t in tokens)
    return (F.octet_length(c) <= longest) & F.array_contains(known, c)


def is_missing(c: Column, dtype: T.DataType | None = None) -> Column:
    """Null, or NaN for a floating column."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def canonical_null(
    df: DataFrame,
    na_tokens: Iterable[str] = NA_TOKENS,
    blanks: bool = True,
) -> DataFrame:
    """Turn null tokens, and optionally blank cells, into SQL NULL in every text column."""
    tokens = list(na_tokens)
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            keep = ~is_na_token(c, tokens)
            if blanks:
                keep = keep & ~is_blank(c)
            c = F.when(keep, c)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        out.append(c.alias(field.name))
    return df.select(*out)


def null_to_empty(df: DataFrame) -> DataFrame:
    """Replace nulls in text columns by the empty string."""
    return df.na.fill("")
