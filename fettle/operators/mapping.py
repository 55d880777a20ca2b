"""Cleaning mapping: build it, apply its accepted part, measure the effect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fettle.functions.alias import DEFAULT_FAMILIES, AliasFamily, accept_label, review_label
from fettle.functions.labels import TOO_DIFFERENT, accepted_reason, review_reason
from fettle.functions.rows import as_rows, beside, computed_once
from fettle.functions.text import normalize_text
from fettle.operators.variants import decision_rank


def build_mapping(
    variants: DataFrame,
    families: Sequence[AliasFamily] = DEFAULT_FAMILIES,
    unique: bool = True,
) -> DataFrame:
    """One row per original value: clean value, status, reason.

    ``variants_report`` lists each value once. For a report edited by hand pass
    ``unique=False``: the first row of a value in report order is kept.
    """
    if not unique:
        report_order = [decision_rank(F.col("decision")), F.desc("count"), "suggested_group"]
        first = F.row_number().over(Window.partitionBy("original_value").orderBy(*report_order))
        variants = variants.withColumn("_nth", first).where("_nth = 1").drop("_nth")
    collapsed = F.col("normalized_value")
    whole = F.col("_whole")
    score = F.col("similarity_score").cast("int")
    accepted = accept_label(collapsed, families).isNotNull()
    candidate = review_label(collapsed, families).isNotNull()
    reason = (
        F.when(
            F.col("decision") == "accepted",
            accepted_reason(whole, accepted, F.col("suggested_group"), score, families),
        )
        .when(
            F.col("decision") == "review",
            review_reason(whole, candidate, score, families),
        )
        .otherwise(F.lit(TOO_DIFFERENT))
    )
    normal = computed_once(normalize_text(F.col("original_value")).alias("_whole"))
    return variants.select("*", normal).select(
        "original_value",
        F.col("suggested_group").alias("clean_value"),
        F.col("decision").alias("status"),
        reason.alias("reason"),
    )


def accepted_only(mapping: DataFrame) -> DataFrame:
    """The accepted part of a mapping."""
    return mapping.where(F.col("status") == "accepted")


def effective(mapping: DataFrame) -> DataFrame:
    """Accepted pairs that change something; a label that maps to itself does not.

    One per original value: of several accepted labels the first in the alphabet counts, so
    that a mapping edited by hand never multiplies rows.
    """
    return (
        accepted_only(mapping)
        .groupBy("original_value")
        .agg(F.min("clean_value").alias("clean_value"))
        .where(F.col("clean_value") != F.col("original_value"))
    )


def changed(raw: Column, clean: Column) -> Column:
    """True when both cells are present and differ."""
    return raw.isNotNull() & clean.isNotNull() & (raw != clean)


def apply_mapping(df: DataFrame, mapping: DataFrame, target: str) -> DataFrame:
    """Add ``<target>_clean`` right after the target: the accepted value, else the original.

    Rows are neither lost nor multiplied. The mapping may grow with the table, so it is not
    forced into a broadcast: the optimiser broadcasts it below its size limit and
    otherwise joins by key, splitting a name that holds many rows.
    """
    if target not in df.columns:
        raise ValueError(f"the table has no column {target}")
    raw = F.col(f"`{target}`")
    columns: list[Column] = []
    for name in df.columns:
        columns.append(F.col(f"`{name}`"))
        if name == target:
            columns.append(F.coalesce(F.col("clean_value"), raw).alias(f"{target}_clean"))
    # The length is implied by the text. As part of the key it keeps a partitioning that the
    # mapping may have by value alone from being reused: both sides are then shuffled for
    # this join, the form in which adaptive execution can split a hot name.
    original = F.col("original_value")
    same = (raw == original) & (F.octet_length(raw) == F.octet_length(original))
    return df.join(effective(mapping), same, "left").select(*columns)


def changed_count(df: DataFrame, raw: str, clean: str) -> DataFrame:
    """Cells that cleaning changed, counted on the cleaned table."""
    test = changed(F.col(f"`{raw}`"), F.col(f"`{clean}`"))
    return df.agg(F.count_if(test).alias("changed_cells"))


def mapping_summary(mapping: DataFrame) -> DataFrame:
    """Mapping rows per status, most frequent first."""
    return (
        mapping.groupBy("status")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "status")
    )


def review_count(mapping: DataFrame) -> DataFrame:
    """Mapping rows left for a person."""
    return mapping.agg(F.count_if(F.col("status") == "review").alias("review_rows"))


def cleaning_summary(df: DataFrame, mapping: DataFrame, target: str) -> DataFrame:
    """Rows processed, corrections available and applied, mapping rows skipped.

    Corrections are counted on distinct values times their rows, not on the table.
    """
    counts = df.groupBy(F.col(f"`{target}`").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    applied = F.when(F.col("clean_value").isNotNull(), F.col("n"))
    rows = counts.join(
        effective(mapping), F.col("value") == F.col("original_value"), "left"
    ).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_processed"),
        F.coalesce(F.sum(applied), F.lit(0)).alias("corrections_applied"),
    )
    accepted = F.count_if(F.col("status") == "accepted")
    sizes = mapping.agg(
        accepted.alias("accepted_available"),
        F.greatest(F.count(F.lit(1)) - accepted, F.lit(0)).alias("mappings_skipped"),
    )
    metrics = [*rows.columns, *sizes.columns]
    return beside(rows, sizes).select(
        as_rows(["metric", "value"], [(F.lit(m), F.col(m)) for m in metrics])
    )
