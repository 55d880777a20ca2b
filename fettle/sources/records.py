"""CSV records with line breaks inside cells, read by many tasks per file.

Files are read as lines, split over tasks as any text is. Whether a line starts a record
depends on all lines before it: it does unless it starts inside a quoted cell. A line is a
function from "starts inside" to "ends inside", and so is a run of lines; there are four such
functions, so what a run does is known from the last of its lines that ends the same way
however it starts, and from the parity of the lines after it that change sides.

1. Each split works out its function, and how many records start in it in either case.
2. Running over the splits of a file, a row each, gives every split its start and the number
   of records before it.
3. Running over the lines of each split then numbers all lines by record. Lines of a record
   are joined inside the split; only what crosses a border between splits is joined again.
"""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Sequence
from io import StringIO

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}

# Places in a record: start of a cell, in a plain cell, in a quoted one, after a quote in one.
_START, _PLAIN, _QUOTED, _AFTER = 0, 1, 2, 3


def _text(place: Column, text: Column) -> Column:
    """The place after text without quotes."""
    moved = F.when(text.endswith(","), _START).otherwise(_PLAIN)
    return F.when((place == _QUOTED) | (text == ""), place).otherwise(moved)


def _quote(place: Column) -> Column:
    """The place after a quote: in a plain cell it is a character like any other."""
    return (
        F.when((place == _START) | (place == _AFTER), _QUOTED)
        .when(place == _QUOTED, _AFTER)
        .otherwise(place)
    )


def ends_inside(line: Column, starts_inside: bool) -> Column:
    """Whether a line that starts inside or outside a quoted cell ends inside one."""
    parts = F.split(line, '"', -1)
    first = _text(F.lit(_QUOTED if starts_inside else _START), F.element_at(parts, 1))
    rest = F.slice(parts, F.lit(2), F.size(parts))
    last = F.aggregate(rest, first, lambda place, text: _text(_quote(place), text))
    return F.when(line.contains('"'), last == _QUOTED).otherwise(F.lit(starts_inside))


def _before(order: list[str], partition: list[str]):
    return Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _with_starts(df: DataFrame, order: list[str], partition: list[str], first: Sequence[bool]) -> DataFrame:
    """Add ``_in_0``, ... : whether each row starts inside, for given starts of its partition.

    Rows have the columns ``_from_out`` and ``_from_in``: whether they end inside, by start.
    """
    turns = (F.col("_from_out") & ~F.col("_from_in")).cast("int")
    so_far = F.coalesce(F.sum(turns).over(_before(order, partition)), F.lit(0))
    df = df.withColumn("_turns", so_far)
    fixed = F.when(
        F.col("_from_out") == F.col("_from_in"), F.struct(F.col("_from_out").alias("inside"), F.col("_turns").alias("at"))
    )
    df = df.withColumn("_fixed", F.last(fixed, ignorenulls=True).over(_before(order, partition)))

    def turned(start: Column, times: Column) -> Column:
        return start != (times % 2 == 1)

    known = turned(F.col("_fixed.inside"), F.col("_turns") - F.col("_fixed.at"))
    starts = [F.coalesce(known, turned(F.lit(s), F.col("_turns"))).alias(f"_in_{i}") for i, s in enumerate(first)]
    return df.select("*", *starts).drop("_turns", "_fixed")


def csv_reader(spark: SparkSession, multi_line: bool = False):
    """Spark's own reader for text tables with a header, every column as text.

    Line by line it breaks records with line breaks in their cells; ``multi_line`` reads them
    whole, at the price of one task per file.
    """
    return spark.read.options(**CSV_OPTIONS, inferSchema="false", multiLine=str(multi_line).lower())


def _is_empty(line: Column) -> Column:
    return (line == "") | (line == "\r")


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    file, block, line = F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.col("value")
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            file.alias("_file"),
            block.alias("_block"),
            F.xxhash64(file, block).alias("_unit"),
            F.monotonically_increasing_id().alias("_id"),
            line.alias("_line"),
            _is_empty(line).alias("_empty"),
            ends_inside(line, False).alias("_from_out"),
            ends_inside(line, True).alias("_from_in"),
        )
    )


def _splits(lines: DataFrame) -> DataFrame:
    """A row for each split: whether it starts and ends inside a cell, its records and those before.

    A file that ends inside a quoted cell ends the job with an error.
    """
    by_line = _with_starts(lines.drop("_line"), ["_id"], ["_unit"], [False, True])
    ends = [F.max_by(F.when(F.col(c), F.col("_from_in")).otherwise(F.col("_from_out")), "_id") for c in ("_in_0", "_in_1")]
    begun = [F.count_if(~F.col(c) & ~F.col("_empty")) for c in ("_in_0", "_in_1")]
    splits = by_line.groupBy("_unit").agg(
        F.first("_file").alias("_file"),
        F.first("_block").alias("_block"),
        ends[0].alias("_from_out"),
        ends[1].alias("_from_in"),
        begun[0].alias("_begun_out"),
        begun[1].alias("_begun_in"),
    )
    placed = _with_starts(splits, ["_block"], ["_file"], [False])
    inside = F.col("_in_0")
    last = F.lead("_block").over(Window.partitionBy("_file").orderBy("_block")).isNull()
    open_ = F.when(inside, F.col("_from_in")).otherwise(F.col("_from_out"))
    broken = F.raise_error(F.concat(F.lit("a quote is not closed in "), F.col("_file"))).cast("boolean")
    placed = placed.select(
        "_file",
        "_block",
        "_unit",
        inside.alias("_starts"),
        F.when(last & open_, broken).otherwise(open_).alias("_ends"),
        F.when(inside, F.col("_begun_in")).otherwise(F.col("_begun_out")).alias("_records"),
    )
    earlier = F.coalesce(F.sum("_records").over(_before(["_block"], ["_file"])), F.lit(0))
    # A row for each file: the first record of each is its header.
    files = placed.groupBy("_file").agg(F.greatest(F.sum("_records") - 1, F.lit(0)).alias("_rows"))
    rows_before = F.coalesce(F.sum("_rows").over(_before(["_file"], [])), F.lit(0))
    shifts = files.select("_file", (rows_before - 1).alias("_shift"))
    return placed.withColumn("_earlier", earlier).join(shifts, "_file").drop("_file", "_block")


def read_records(spark: SparkSession, path: str | list[str], name: str = "row_number") -> DataFrame:
    """Records of CSV files with a header each, as text in ``record``, numbered from 1.

    Files come by path, records as they stand. A record ends with a line feed, or a carriage
    return and one; lines without a character between records count for nothing. A quoted
    cell may hold line breaks and doubled quotes, and span any number of splits. A quote
    inside a cell that does not start with one is a character.
    """
    lines = _lines(spark, path)
    splits = _splits(lines).withColumnRenamed("_unit", "_of")
    placed = lines.join(splits, F.col("_unit") == F.col("_of"), "left")
    # Split borders follow the session's settings; if they moved between the two scans, stop.
    moved = F.raise_error(F.lit("the splits of the files changed while they were read")).cast("boolean")
    placed = _with_starts(placed, ["_id"], ["_unit"], [False, True])
    starts = F.coalesce(F.col("_starts"), moved)
    placed = placed.withColumn("_continues", F.when(starts, F.col("_in_1")).otherwise(F.col("_in_0")))
    placed = placed.where(F.col("_continues") | ~F.col("_empty"))
    begun = F.sum((~F.col("_continues")).cast("long")).over(Window.partitionBy("_unit").orderBy("_id"))
    placed = placed.withColumn("_record", begun)

    def joined(order: str, text: str) -> Column:
        listed = F.sort_array(F.collect_list(F.struct(F.col(order), F.col(text).alias("text"))))
        return F.array_join(listed["text"], "\n")

    pieces = placed.groupBy("_unit", "_record").agg(
        joined("_id", "_line").alias("_text"),
        F.first("_file").alias("_file"),
        F.first("_block").alias("_block"),
        (F.first("_earlier") + F.col("_record")).alias("_nth"),
        F.first("_shift").alias("_shift"),
        ((F.col("_record") == 0) | F.first("_ends") & (F.col("_record") == F.first("_records"))).alias("_cut"),
    )
    # Two pieces of a split at most: the only ones that travel again.
    whole = pieces.where("not _cut").select("_nth", "_shift", "_text")
    mended = pieces.where("_cut").groupBy("_file", "_nth").agg(F.first("_shift").alias("_shift"), joined("_block", "_text").alias("_text"))
    records = whole.unionByName(mended.select("_nth", "_shift", "_text")).where("_nth > 1")
    bare = F.when(F.col("_text").endswith("\r"), F.expr("left(_text, char_length(_text) - 1)")).otherwise(F.col("_text"))
    return records.select((F.col("_nth") + F.col("_shift")).alias(name), bare.alias("record"))


def _first_record(lines: list[str]) -> list[str]:
    return next((r for r in csv.reader(StringIO("\n".join(lines) + "\n", newline="")) if r), [])


def header(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names of the first file that has a record: a few lines of it are read.

    A name that is empty is ``_c`` and its place; one that comes twice is followed by its place.
    """
    scan = spark.read.option("lineSep", "\n").text(path)
    for file in sorted(scan.inputFiles()):
        # A path without a host is written with one slash there.
        same = F.col("_metadata.file_path").isin(file, re.sub("^([a-z]+):///", r"\1:/", file))
        own = scan.where(same & (F.col("_metadata.file_block_start") == 0))
        n, names, whole = 64, [], False
        while not whole:
            lines = [r.value for r in own.limit(n).collect()]
            # The record is whole when it is the same with half of the lines, or they are all.
            half, names = _first_record(lines[: n // 2]), _first_record(lines)
            whole, n = half == names or len(lines) < n, 4 * n
        if names:
            often = Counter(c.lower() for c in names)
            return [c + str(i) * (often[c.lower()] > 1) if c else f"_c{i}" for i, c in enumerate(names)]
    return []


def read_csv_table(
    spark: SparkSession,
    path: str | list[str],
    name: str = "row_number",
    schema: T.StructType | None = None,
) -> DataFrame:
    """The records with their cells: the number, then a column for each of the header or schema.

    Without a schema all cells are text, named by the header of the first file. Cells that a
    record lacks are null, cells beyond the header are left out.
    """
    columns = schema.fields if schema else [T.StructField(c, T.StringType()) for c in header(spark, path)]
    if not columns:
        raise ValueError(f"no header in {path}")
    kinds = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in columns)
    cells = F.from_csv("record", kinds, {**CSV_OPTIONS, "header": "false", "multiLine": "true"})
    return read_records(spark, path, name).select(name, cells.alias("_cells")).select(name, "_cells.*")
