"""Turn the fields of one row into several rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_rows(names: Sequence[str], values: Sequence[Sequence[Column]]) -> Column:
    """Generator of one output row per entry of ``values``, with the given column names."""
    return F.inline(
        F.array(*[F.struct(*[v.alias(n) for n, v in zip(names, row)]) for row in values])
    )


def computed_once(*values: Column) -> Column:
    """Columns evaluated once per row, however often later steps use them.

    A filter on the result of a projection is moved below it and evaluates the expression
    again; one on the output of a generator is not. Use it for costly text expressions.
    """
    return F.inline(F.array(F.struct(*values)))


def beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """The columns of two single-row relations as one row, without a join."""
    both = left.unionByName(right, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])
