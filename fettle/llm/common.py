"""Shared steps: written intermediate tables, ranks inside groups, shingle words."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fettle.plans.session import work_path

# Rows of one group are ranked in independent blocks, so that a hot group is spread over many
# tasks: 2 ** RANK_BITS at least, and so many that a block has RANK_ROWS rows on average if all
# rows are of one group.
RANK_BITS = 10
RANK_ROWS = 1 << 18


_KEPT: dict[str, Any] = {}


def worker_cache(name: str, make: Callable[[], Any]) -> Any:
    """An object that later tasks of a worker process find again.

    A worker holds one at a time: the next operator's takes the place of the last one's, so
    that the stages of a pipeline do not add up in memory.
    """
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


# Paths of the tables that are dropped when the steps around them are done.
_SCOPES: list[list[str]] = []


@contextmanager
def dropped_after(spark: SparkSession) -> Iterator[None]:
    """Drops the tables that the steps inside store, but for those stored with ``keep``.

    For steps whose result is itself stored, or otherwise used up, inside.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in map(spark._jvm.org.apache.hadoop.fs.Path, _SCOPES.pop()):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage: a lost executor costs the tasks it ran, not the steps before, and
    values that a second run could change (row ids) are fixed from here on.
    """
    path = work_path(df.sparkSession, name)
    if _SCOPES and not keep:
        _SCOPES[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rank_bits(rows: int) -> int:
    """log2 of the number of rank blocks for a table of so many rows."""
    return max(RANK_BITS, math.ceil(math.log2(max(1, rows / RANK_ROWS))))


def with_rank(df: DataFrame, group: str, order: list[str], name: str, blocks: Column | None = None) -> DataFrame:
    """Add a gapless 0-based rank inside each group, whatever the size of the group.

    Ranks follow a hash of ``order``. Rows of a group are dealt over blocks by its first bits,
    ranked inside each block and moved by the number of rows in the blocks before; the number
    of blocks grows with the table and has no effect on the ranks. Rows that are equal in all
    of ``order`` get different ranks. The input is counted, and read twice. With ``blocks``,
    numbers that never fall along ``order``, these are the blocks, and ranks follow ``order``
    over the whole group.
    """
    rows = df
    if blocks is None:
        rows = rows.withColumn("_hash", F.xxhash64(*order))
        blocks, order = F.shiftright("_hash", 64 - rank_bits(df.count())), ["_hash", *order]
    rows = rows.withColumn("_block", blocks)
    sizes = rows.groupBy(group, "_block").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col(group).alias("_of"),
        F.col("_block").alias("_in"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
    )
    inside = F.row_number().over(Window.partitionBy(group, "_block").orderBy(*order)) - 1
    return (
        rows.join(starts, (F.col(group) == F.col("_of")) & (F.col("_block") == F.col("_in")))
        .withColumn(name, F.col("_start") + inside)
        .drop("_hash", "_block", "_of", "_in", "_start")
    )
