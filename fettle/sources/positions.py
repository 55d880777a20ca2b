"""Dense 1-based row numbers without sorting a table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fettle.sources.records import csv_reader, read_csv_table

# Rows are numbered inside blocks of 2^20 consecutive keys, blocks inside groups of 2^22.
# Any 64-bit key then needs at most 2^22 groups, so no window sees more than 2^22 rows.
_BLOCK_BITS = 20
_GROUP_BITS = 42
_PARTS = 4096


def _before(order: list[str], partition: list[str] | None = None):
    spec = Window.partitionBy(*partition) if partition else Window.partitionBy()
    return spec.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _running_total(df: DataFrame, value: str, out: str, order, partition=None) -> DataFrame:
    total = F.sum(value).over(_before(order, partition))
    return df.withColumn(out, F.coalesce(total, F.lit(0)))


def with_row_number(df: DataFrame, key: str, name: str = "row_number") -> DataFrame:
    """Add the position of each row in the order of a unique integer key.

    Equal to ``row_number() over (order by key)``, but the work is split by key range:
    each block is numbered on its own and shifted by the count of all earlier rows.
    A block has at most 2^20 rows whatever the data, because the key is unique. A row
    without a key, or a key that comes twice, ends the job with an error.
    """
    if not isinstance(df.schema[key].dataType, (T.LongType, T.IntegerType, T.ShortType)):
        raise TypeError(f"row numbers need an integer key, {key} is not one")
    missing = F.raise_error(F.lit(f"{key} is null, but numbers the rows")).cast("bigint")
    block = F.shiftright(F.coalesce(F.col(key).cast("bigint"), missing), _BLOCK_BITS)
    group = F.shiftright(F.col("_block"), _GROUP_BITS - _BLOCK_BITS)

    sizes = df.groupBy(block.alias("_block")).agg(F.count(F.lit(1)).alias("_rows"))
    sizes = sizes.withColumn("_group", group)
    in_group = _running_total(sizes, "_rows", "_in_group", ["_block"], ["_group"])
    groups = sizes.groupBy("_group").agg(F.sum("_rows").alias("_rows"))
    before_group = _running_total(groups, "_rows", "_before_group", ["_group"])
    offsets = in_group.join(before_group.drop("_rows"), "_group").select(
        "_block", (F.col("_in_group") + F.col("_before_group")).alias("_offset")
    )

    in_order = Window.partitionBy("_block").orderBy(key)
    repeated = F.raise_error(F.concat(F.lit(f"{key} is not unique: "), F.col(key).cast("string"))).cast("int")
    again = F.lag(key).over(in_order) == F.col(key)
    in_block = F.when(again, repeated).otherwise(F.row_number().over(in_order))
    numbered = df.withColumn("_block", block).withColumn("_in_block", in_block)
    return (
        numbered.join(offsets, "_block")
        .withColumn(name, F.col("_in_block") + F.col("_offset"))
        .drop("_block", "_in_block", "_offset")
    )


def _shift_of(unit: Column, sizes: DataFrame, order: list[str], first: Column | int = 0) -> Column:
    """The number of rows in all earlier files or splits, less ``first``, by the unit of a row.

    There is a row of two numbers for each file, fewer bytes than the listing that the driver
    holds to plan the scan. They reach the tasks as the one value of a subquery: the optimiser
    takes a count by file to be as large as a part of the table, and would join by unit, which
    moves all rows of a file to one task. The pairs are dealt over _PARTS maps, as a look into a
    map takes time by its size.
    """
    part, first = F.pmod(F.col("_unit"), F.lit(_PARTS)), first if isinstance(first, Column) else F.lit(first)
    totals = _running_total(sizes, "_rows", "_offset", order).withColumn("_shift", F.col("_offset") - first)
    maps = totals.groupBy(part.alias("_part")).agg(_as_map("_unit", "_shift").alias("_map"))
    dealt = F.transform(F.sequence(F.lit(0), F.lit(_PARTS - 1)), lambda p: F.col("_maps")[p.cast("long")])
    found = maps.agg(_as_map("_part", "_map").alias("_maps")).select(dealt.alias("_dealt")).scalar()
    moved = F.raise_error(F.lit("the files changed while they were read")).cast("bigint")
    # A shift is never null, and the optimiser is to know it.
    return F.coalesce(found[F.pmod(unit, F.lit(_PARTS)).cast("int")][unit], moved, F.lit(0).cast("bigint"))


def _as_map(key: str, value: str) -> Column:
    return F.map_from_entries(F.collect_list(F.struct(key, value)))


def read_parquet_numbered(spark: SparkSession, path: str, name: str = "row_number") -> DataFrame:
    """Parquet scan with the position of each row: files by path, rows as stored.

    Needs no shuffle of the table: the reader gives each row its place in its file.
    """
    return number_scan(spark.read.parquet(path), name)


def number_scan(scan: DataFrame, name: str = "row_number") -> DataFrame:
    """The same for a Parquet scan at hand."""
    file = F.col("_metadata.file_path")
    # The metadata of a file is constant, so counting reads no column.
    sizes = scan.groupBy(file.alias("_file")).agg(F.count(F.lit(1)).alias("_rows"))
    sizes = sizes.withColumn("_unit", F.xxhash64("_file"))
    shift = _shift_of(F.xxhash64(file), sizes, ["_file"])
    number = (shift + F.col("_metadata.row_index") + 1).alias(name)
    return scan.select(number, *[F.col(f"`{c}`") for c in scan.columns])


def read_csv_numbered(
    spark: SparkSession, path: str, name: str = "row_number", multi_line: bool = False
) -> DataFrame:
    """CSV scan with the position of each row: files by path, then order in the file.

    Meant for ingest, once, followed by a snapshot. Cells may hold line breaks; files are
    split over tasks all the same. ``multi_line`` reads each file in one task instead: its row
    ids are then consecutive, and the id of its first row places the others.
    """
    if not multi_line:
        return read_csv_table(spark, path, name)
    scan = csv_reader(spark, True).csv(path)
    file, begin = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    first = scan.select(file.alias("_file"), begin.alias("_start"), F.monotonically_increasing_id().alias("_id"))
    sizes = first.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first"))
    sizes = sizes.withColumn("_unit", F.xxhash64("_file", "_start"))
    shift = _shift_of(F.xxhash64(file, begin), sizes, ["_file", "_start"], F.col("_first"))
    number = (shift + F.monotonically_increasing_id() + 1).alias(name)
    return scan.select(number, *[F.col(f"`{c}`") for c in scan.columns])
