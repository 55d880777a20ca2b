"""Scans, samples, snapshots and sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fettle.functions.nulls import NA_TOKENS, canonical_null
from fettle.functions.rows import beside
from fettle.functions.shapes import stable_text
from fettle.sources.records import CSV_OPTIONS, csv_reader, read_csv_table


def read_text_table(
    spark: SparkSession,
    path: str | list[str],
    cols: Sequence[str] | None = None,
    na_tokens: Iterable[str] = NA_TOKENS,
    multi_line: bool = False,
) -> DataFrame:
    """Read a CSV table as text; null tokens become NULL, blank cells stay.

    Cells may hold line breaks; files are split over tasks all the same. ``multi_line`` reads
    each file in one task instead, which saves a shuffle where files are many and small.
    """
    df = csv_reader(spark, True).csv(path) if multi_line else read_csv_table(spark, path, "_nth").drop("_nth")
    if cols is not None:
        df = df.select(*[F.col(f"`{c}`") for c in cols])
    return canonical_null(df, na_tokens, blanks=False)


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """A relation without rows."""
    return spark.createDataFrame([], schema)


def read_report(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "csv"
) -> DataFrame:
    """Read a saved report; a report that was never written is an empty relation."""
    try:
        if fmt != "csv":
            return spark.read.format(fmt).schema(schema).load(path)
        kinds = schema if isinstance(schema, T.StructType) else empty(spark, schema).schema
        return read_csv_table(spark, path, "_nth", kinds).drop("_nth")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty(spark, schema)
        raise


def resolve_target(df: DataFrame, preferred: str) -> str:
    """The preferred column if the table has it, else its first column."""
    if not df.columns:
        raise ValueError("the table has no columns")
    return preferred if preferred in df.columns else df.columns[0]


def existing(df: DataFrame, cols: Iterable[str]) -> list[str]:
    """Those of the wanted columns that the table has, in the wanted order."""
    return [c for c in cols if c in df.columns]


def sample_rows(
    df: DataFrame, n: int, order: str, cols: Sequence[str] | None = None
) -> DataFrame:
    """First n rows in source order."""
    picked = df.orderBy(F.col(order)).limit(n)
    return picked if cols is None else picked.select(*existing(df, cols))


def dataset_overview(df: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def file_overview(scan: DataFrame) -> DataFrame:
    """Bytes, files, rows and columns of a file scan, in one pass that reads no column data."""
    per_file = scan.groupBy(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
    ).agg(F.count(F.lit(1)).alias("rows"))
    return per_file.agg(
        F.sum("file_size").alias("bytes"),
        F.count(F.lit(1)).alias("files"),
        F.sum("rows").alias("rows"),
    ).withColumn("columns", F.lit(len(scan.columns)))


def to_text_snapshot(df: DataFrame) -> DataFrame:
    """Every column as stable text; null gives the empty string."""
    return df.select(
        *[stable_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]
    )


def file_listing(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path, length and modificationTime of files, listed by the cluster; no file is opened."""
    if not paths:
        return empty(spark, "path string, modificationTime timestamp, length bigint")
    return spark.read.format("binaryFile").load(list(paths)).select("path", "modificationTime", "length")


def files_overview(scan: DataFrame) -> DataFrame:
    """Bytes, files, rows and columns of a file scan; files without rows count too."""
    paths = [unquote(p) for p in scan.inputFiles()]
    listed = file_listing(scan.sparkSession, paths).agg(
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("files")
    )
    rows = scan.agg(F.count(F.lit(1)).alias("rows"))
    return beside(listed, rows).withColumn("columns", F.lit(len(scan.columns)))


class _Files:
    """Files and folders of the store that a path is in."""

    def __init__(self, spark: SparkSession, path: str):
        self.path_of = spark._jvm.org.apache.hadoop.fs.Path
        self.store = self.path_of(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.store.exists(self.path_of(path))

    def delete(self, path: str) -> None:
        self.store.delete(self.path_of(path), True)

    def move(self, path: str, to: str) -> None:
        if not self.store.rename(self.path_of(path), self.path_of(to)):
            raise OSError(f"{path} cannot be renamed to {to}")


def _beside(path: str, kind: str) -> str:
    folder, _, name = path.rstrip("/").rpartition("/")
    # Spark's readers pass over names that start with a dot.
    return f"{folder}/.{name}.{kind}" if folder or path.startswith("/") else f".{name}.{kind}"


def recover(spark: SparkSession, path: str) -> None:
    """Bring back what stood at a path if a replacement was cut off between its two renames."""
    files, old = _Files(spark, path), _beside(path, "old")
    if not files.exists(path) and files.exists(old):
        files.move(old, path)


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder to write to that takes the place of ``path`` when the steps inside have ended.

    Until then, and if they fail, what is at ``path`` stays and may be read, by them too. The
    switch is two renames, each at once on a file system; where a store copies to rename,
    readers can meet a folder half moved.
    """
    recover(spark, path)
    files, new, old = _Files(spark, path), _beside(path, f"new-{uuid.uuid4().hex}"), _beside(path, "old")
    try:
        yield new
        if not files.exists(new):
            raise ValueError(f"nothing was written for {path}")
        files.delete(old)
        if files.exists(path):
            files.move(path, old)
        files.move(new, path)
        files.delete(old)
    finally:
        files.delete(new)


_MANIFEST = "_manifest"


def _manifest(df: DataFrame) -> DataFrame:
    """One row: the schema of a table, and a digest of its input files with sizes and times.

    Sums over the listing, so that it is one aggregate however many files there are.
    """
    files = file_listing(df.sparkSession, [unquote(p) for p in df.inputFiles()])
    digest = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(digest), F.lit(0)).cast("string").alias("digest"),
        F.max("modificationTime").alias("changed"),
    ).withColumn("schema", F.lit(df.schema.json()))


def write_snapshot(df: DataFrame, path: str, force: bool = False) -> DataFrame:
    """Write a table once as Parquet and read it back.

    A snapshot is reused while its input files, with their sizes and times, and the schema are
    those of its manifest, which is written last; so one left half-written has none and is
    written again. A table that reads no files is reused as long as its schema holds. Other
    steps over the same input are not told apart: use another path, or ``force``. The new
    snapshot takes the place of the old one when it is whole, and may be made from it.
    """
    spark = df.sparkSession
    recover(spark, path)
    now = [] if force else _manifest(df).collect()
    if not force and _Files(spark, path).exists(f"{path}/{_MANIFEST}/_committed"):
        if spark.read.parquet(f"{path}/{_MANIFEST}/_committed").collect() == now:
            return spark.read.parquet(path)
    manifest = _manifest(df)
    # Taken before the table is written: input that changes meanwhile is noticed next time.
    row = spark.createDataFrame(manifest.collect(), manifest.schema)
    with replacing(spark, path) as new:
        df.write.parquet(new)
        row.coalesce(1).write.parquet(f"{new}/{_MANIFEST}/_writing")
        _Files(spark, new).move(f"{new}/{_MANIFEST}/_writing", f"{new}/{_MANIFEST}/_committed")
    return spark.read.parquet(path)


def _write(df: DataFrame, path: str, fmt: str) -> None:
    writer = df.write.mode("append")
    if fmt == "csv":
        # Leading and trailing blanks of a cell are data here.
        writer = writer.options(
            **CSV_OPTIONS, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
        )
    writer.format(fmt).save(path)


@contextmanager
def report_parts(spark: SparkSession, path: str, fmt: str = "csv") -> Iterator[Callable[[DataFrame], None]]:
    """Replace a report by several parts, each added by a call, all of them or none."""
    with replacing(spark, path) as new:
        yield lambda df: _write(df, new, fmt)


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Replace a report: header, UTF-8, quotes doubled inside cells.

    The old report stays until the new one is whole, so it may be made from the old one.
    """
    with report_parts(df.sparkSession, path, fmt) as add:
        add(df)
