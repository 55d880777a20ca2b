"""Grouping keys for duplicate rules."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from fettle.functions.nulls import strip


def _filled(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def stripped_cells(columns: Iterable[str], prefix: str = "") -> list[Column]:
    """Trimmed text of each column, null as empty, under its own or a prefixed name."""
    return [strip(_filled(c)).alias(f"{prefix}{c}") for c in columns]


def complete_key(columns: Sequence[str]) -> Column:
    """True when every one of some trimmed columns is non-empty."""
    return reduce(lambda a, b: a & b, [F.col(f"`{c}`") != "" for c in columns])


def compound_key(parts: Sequence[tuple[str, str]], prefix: str = "") -> Column:
    """Text ``label=value|label=value`` of trimmed columns; null when a part is empty."""
    pieces: list[Column] = []
    for i, (label, name) in enumerate(parts):
        pieces += [F.lit(f"{'|' if i else ''}{label}="), F.col(f"`{prefix}{name}`")]
    complete = complete_key([f"{prefix}{name}" for _, name in parts])
    return F.when(complete, F.concat(*pieces))


def row_key(columns: Iterable[str]) -> Column:
    """SHA-256 over all given columns of a row; null and empty are the same value.

    Each value is preceded by its length in bytes, so different rows give different input.
    """
    pieces: list[Column] = []
    for name in columns:
        value = _filled(name)
        pieces += [F.octet_length(value).cast("string"), F.lit(":"), value]
    return F.sha2(F.concat(*pieces), 256)
