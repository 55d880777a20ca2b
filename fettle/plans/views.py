"""Derived inputs of the registered queries: texts with headings, questions, figures.

As in the grants view, each expression is plain SQL that Spark and other engines share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fettle.functions.nulls import canonical_null
from fettle.plans.grants import COLUMNS, grants, table

# Every third text gets a heading before each line, the others one closing section.
SECTIONED_TEXT = """CASE WHEN doc_id % 3 = 0
    THEN '# Report ' || CAST(doc_id AS string) || chr(10) || replace(text, chr(10), chr(10) || '## ')
    ELSE text || chr(10) || '### Notes on ' || lang || chr(10) || 'The duplicate values of ' || source END"""

# Texts that quote some of the summary figures.
FIGURES_TEXT = """text || CASE WHEN doc_id % 2 = 0
    THEN chr(10) || '- Original rows: ' || CAST(doc_id AS string) || ',000' || chr(10)
        || '- Columns: ' || CAST(doc_id % 40 AS string) || chr(10)
        || '- Unique raw organization names: ' || CAST(doc_id + 7 AS string) || ',631'
    WHEN doc_id % 5 = 0
    THEN chr(10) || '- Unique cleaned organization names: 70,046' || chr(10)
        || '- Total duplicate rows flagged across rules: ' || CAST(doc_id AS string) || chr(10)
        || '- Corrections applied in the cleaned file: 10,162' || chr(10)
        || '- Corrections left for review: 2,' || CAST(100 + doc_id % 900 AS string)
    ELSE '' END"""

# Conversation turns that ask about a quoted name, a reference or an acronym.
QUESTION_TEXT = """CASE conv_id % 5
    WHEN 0 THEN text || ' Show "blue gear" please, see REF-1-2.'
    WHEN 1 THEN 'Find R-12/34#' || CAST(conv_id AS string) || ' ' || text
    WHEN 2 THEN text || ' REPORT on COOP and ESGUQAM or AQAMXYZ.'
    WHEN 3 THEN 'DATA ABOUT it: ' || text
    ELSE text END"""

# Copies that follow the table: far past its last row number.
COPY_OFFSET = 1_000_000_000_000
COPY_EVERY = 50


def read_grants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grants view as a text scan gives it: null tokens are null, blanks stay."""
    return canonical_null(grants(spark, sf_dir), blanks=False)


def grants_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grants view followed by a copy of some of its rows."""
    view = grants(spark, sf_dir)
    copies = view.where(F.col("row_number") % COPY_EVERY == COPY_EVERY - 1).select(
        (F.col("row_number") + COPY_OFFSET).alias("row_number"), *COLUMNS
    )
    return view.unionByName(copies)


def sectioned_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with headings."""
    return table(spark, sf_dir, "documents").selectExpr("doc_id", f"{SECTIONED_TEXT} AS content")


def documents_with_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that quote summary figures."""
    return table(spark, sf_dir, "documents").selectExpr("doc_id", f"{FIGURES_TEXT} AS content")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns with lookup terms."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn", f"{QUESTION_TEXT} AS question"
    )
