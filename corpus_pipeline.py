"""A corpus pipeline: language, boilerplate lines, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet
and reads it back as the documents of the next stage. All but the last return the columns
doc_id, text, lang, source and n_chars; other columns are left behind. doc_id names a
document. Null and empty texts, repeated rows and empty tables are handled as the operators
say; a document without a letter has no language and goes in the first stage.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fettle.llm import jaccard, language, lines, mixing, queries
from fettle.llm.common import dropped_after, stored
from fettle.sources.positions import number_scan, with_row_number

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NEAR_WORDS = 5
NEAR_PERCENT = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; the others go."""
    learnt = language.sample_dictionaries(docs.where(~language.held_out(F.col("doc_id"))))
    return language.identify(docs.select(*COLUMNS), learnt).where("accepted").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; n_chars is that of the rest.

    Copies of a text count once here: the next stage has to find one of them whole.
    """
    left = lines.drop_boilerplate(docs.select(*COLUMNS), copies_once=True)
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest doc_id.

    Of several rows with one doc_id and one text the first stays. Rows without a doc_id stay.
    """
    with dropped_after(spark):
        groups = jaccard.jaccard_components(docs, NEAR_WORDS, NEAR_PERCENT)
        others = groups.where("component_id <> doc_id").select("doc_id").distinct()
        others = stored(others, "others", keep=True)
    left = docs.select(*COLUMNS).join(others, "doc_id", "left_anti")
    copy = F.row_number().over(Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("n_chars"))
    first = left.withColumn("_copy", copy).where("_copy = 1 or doc_id is null")
    return first.select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the mix, files by name and rows as stored.

    A source weighs its size to the power 0.7. Every document is there at least once;
    smaller sources are repeated, in later epochs, until the largest ends.
    """
    mixed = mixing.mix(docs.select(*COLUMNS))
    return mixed.repartitionByRange("slot").sortWithinPartitions("slot").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens.

    The pieces of a length class fill its sequences in the order of the documents, which is
    that of the mix: files by name, rows as stored. Rows that come from no file are taken as
    they come.
    """
    if _in_files(docs):
        placed = number_scan(docs.select("doc_id", "text"), "place")
    else:
        placed = stored(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_id")), "placed")
        placed = with_row_number(placed, "_id", "place").drop("_id")
    return queries.packed_pieces(placed.withColumn("place", F.col("place") - 1), "place")


def _in_files(docs: DataFrame) -> bool:
    """Whether the rows are as read from files, so that they have a place in one."""
    try:
        docs.select("_metadata.row_index").schema
    except AnalysisException:
        return False
    return True


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

# Compression and scheduling are beyond SQL: tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from documents to packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with dropped_after(spark):
            docs = stored(stage(spark, docs, sf_dir), name, keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
