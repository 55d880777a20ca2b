"""Filters, searches and ordered excerpts of reports and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fettle.functions.shapes import to_number
from fettle.functions.tokens import any_contains
from fettle.sources.tables import existing

ALL = "All"


def _text_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[Column]:
    return [F.col(f"`{c}`").cast("string") for c in (cols if cols is not None else df.columns)]


def filter_value(df: DataFrame, col: str, value: str | None = None) -> DataFrame:
    """Rows with one category value; no value or ``All`` keeps every row."""
    if value is None or value in ("", ALL):
        return df
    return df.where(F.col(f"`{col}`") == value)


def filter_range(df: DataFrame, col: str, lo: float = 20.0, hi: float = 100.0) -> DataFrame:
    """Rows whose value, read as a number, lies in a closed range."""
    return df.where(to_number(F.col(f"`{col}`").cast("string")).between(lo, hi))


def search_report(
    df: DataFrame,
    query: str,
    limit: int | None = 200,
    where: tuple[str, str | None] | None = None,
    order: Sequence[Column | str] = (),
) -> DataFrame:
    """Rows of a report with the text in any column; a blank query keeps every row.

    ``order`` is the order of the report; a limit needs one.
    """
    if limit is not None and not order:
        raise ValueError("a limit needs an order")
    found = filter_value(df, *where) if where else df
    if query.strip():
        found = found.where(any_contains(_text_columns(df), query))
    if order:
        found = found.orderBy(*order)
    return found if limit is None else found.limit(limit)


# Row numbers of the first range that is searched, how much further each next one goes, and how
# many are tried before the whole table is searched at once.
FIRST_RANGE = 1 << 16
RANGE_GROWTH = 16
RANGES = 3


def enough_rows(
    found: DataFrame, order: str, limit: int, first: int = FIRST_RANGE, growth: int = RANGE_GROWTH, ranges: int = RANGES
) -> int | None:
    """A row number up to which there are ``limit`` rows, or None if the first ranges have fewer.

    Ranges grow by a factor, so those that do not suffice cost a part of the last one. On a
    snapshot in the order of its numbers each is read alone, by the statistics of its files.
    """
    n, lo, hi = 0, 0, first
    for _ in range(ranges):
        n += found.where((F.col(order) > lo) & (F.col(order) <= hi)).limit(limit).count()
        if n >= limit:
            return hi
        lo, hi = hi, hi * growth
    return None


def first_rows(df: DataFrame, test: Column, order: str, limit: int, numbered: bool = False) -> DataFrame:
    """The first rows by number that pass a test.

    ``numbered`` says that the table is stored in the order of its numbers, as a snapshot of a
    numbered scan is. Then only as much is read, from the start, as holds ``limit`` rows.
    """
    found = df.where(test)
    if numbered and limit > 0 and (end := enough_rows(found, order, limit)) is not None:
        found = df.where(F.col(order) <= end).where(test)
    return found.orderBy(order).limit(limit)


def search_table(
    df: DataFrame,
    query: str,
    cols: Sequence[str],
    limit: int = 100,
    order: str = "row_number",
    numbered: bool = False,
) -> DataFrame:
    """First rows, in source order, with the text in one of the columns.

    A blank query finds nothing. Columns the table lacks are ignored. ``numbered`` as for
    ``first_rows``.
    """
    cols = existing(df, cols)
    if not query.strip():
        return df.select(*cols).limit(0)
    return first_rows(df, any_contains(_text_columns(df, cols), query), order, limit, numbered).select(*cols)


def preview(
    raw: DataFrame,
    clean: DataFrame,
    query: str,
    cols: Sequence[str],
    limit: int = 40,
    order: str = "row_number",
) -> DataFrame:
    """The same search on the raw and the cleaned table, marked by side."""
    shown = [order, *[c for c in cols if c != order]]

    def side(df: DataFrame, name: str) -> DataFrame:
        own = existing(df, cols)
        hits = df.where(any_contains(_text_columns(df, own), query)).orderBy(order).limit(limit)
        return hits.select(F.lit(name).alias("side"), *existing(df, shown))

    if not query.strip():
        raw, clean = raw.limit(0), clean.limit(0)
    return side(raw, "raw").unionByName(side(clean, "clean"), allowMissingColumns=True)


def top_rows(
    df: DataFrame, col: str, n: int = 20, ascending: bool = False, order: Sequence[str] = ()
) -> DataFrame:
    """First n rows by a text column read as a number; text that is no number comes last."""
    if col in df.columns:
        number = to_number(F.col(f"`{col}`").cast("string"))
        order = [number.asc_nulls_last() if ascending else number.desc_nulls_last(), *order]
    if not order:
        raise ValueError(f"the table has no column {col}, and a limit needs an order")
    return df.orderBy(*order).limit(n)


def clip_cells(df: DataFrame, n: int = 240) -> DataFrame:
    """Every cell as text of at most n characters."""
    return df.select(
        *[F.substring(F.col(f"`{c}`").cast("string"), 1, n).alias(c) for c in df.columns]
    )
