"""Duplicate groups under several key rules, and their summaries."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fettle.functions.keys import compound_key, row_key, stripped_cells
from fettle.functions.nulls import NA_TOKENS, canonical_null, null_to_empty
from fettle.functions.rows import as_rows


@dataclass(frozen=True)
class KeyRule:
    """A named rule: rows agree on (label, column) parts; without parts, on whole rows."""

    name: str
    parts: tuple[tuple[str, str], ...] = ()


# The four rules, and the columns shown for the first row of a group.
EXACT_ROW = KeyRule("exact_row")
REF_NUMBER = KeyRule("ref_number", (("ref_number", "ref_number"),))
ORG_DATE_VALUE = KeyRule(
    "org_date_value",
    (
        ("org", "recipient_legal_name"),
        ("date", "agreement_start_date"),
        ("value", "agreement_value"),
    ),
)
ORG_CITY_POSTAL = KeyRule(
    "org_city_postal",
    (
        ("org", "recipient_legal_name"),
        ("city", "recipient_city"),
        ("postal", "recipient_postal_code"),
    ),
)
DEFAULT_RULES = (EXACT_ROW, REF_NUMBER, ORG_DATE_VALUE, ORG_CITY_POSTAL)
SAMPLE_COLUMNS = (
    "ref_number",
    "recipient_legal_name",
    "recipient_city",
    "recipient_postal_code",
    "agreement_start_date",
    "agreement_value",
)


def duplicate_groups(
    df: DataFrame,
    rules: Sequence[KeyRule] = DEFAULT_RULES,
    row_number: str = "row_number",
    exclude: Iterable[str] = (),
) -> DataFrame:
    """Groups of more than one row: rule, key, size, lowest row number.

    ``df`` has its nulls made empty. All rules share one scan and one shuffle, and the
    counts are combined before it, so a key held by many rows costs one row per task.
    A rule on a column the table lacks finds nothing.
    """
    skip = set(exclude)
    usable = [r for r in rules if all(column in df.columns for _, column in r.parts)]
    used = dict.fromkeys(column for r in usable for _, column in r.parts)
    # Each part is trimmed once per row, whatever the number of rules that use it.
    cells = [F.col(row_number).alias("_row"), *stripped_cells(used, "_key_")]
    if any(not r.parts for r in usable):
        # Half as long as its text, which only the groups shown need.
        cells.append(F.unhex(row_key(c for c in df.columns if c not in skip)).alias("_whole"))
    # The keys of a task are held in memory until it ends: the rule is a number in them.
    keys = [
        (F.lit(i), compound_key(r.parts, "_key_").cast("binary") if r.parts else F.col("_whole"))
        for i, r in enumerate(usable)
    ]
    names = F.lit(None).cast("string")
    text = F.col("_key").cast("string")
    for i, r in enumerate(usable):
        names = F.when(F.col("_rule") == i, F.lit(r.name)).otherwise(names)
        if not r.parts:
            text = F.when(F.col("_rule") == i, F.lower(F.hex("_key"))).otherwise(text)
    return (
        df.select(*cells)
        .select("_row", as_rows(["_rule", "_key"], keys))
        .where(F.col("_key").isNotNull())
        .groupBy("_rule", "_key")
        .agg(F.count(F.lit(1)).alias("duplicate_count"), F.min("_row").alias("sample_row_number"))
        .where(F.col("duplicate_count") > 1)
        .select(names.alias("duplicate_type"), text.alias("duplicate_key"), "duplicate_count", "sample_row_number")
    )


def duplicate_report(
    df: DataFrame,
    rules: Sequence[KeyRule] = DEFAULT_RULES,
    sample_cols: Sequence[str] = SAMPLE_COLUMNS,
    row_number: str = "row_number",
    exclude: Iterable[str] = (),
    na_tokens: Iterable[str] = NA_TOKENS,
    ordered: bool = True,
) -> DataFrame:
    """Duplicate groups with the fields of their first row, by rule and size if ``ordered``.

    ``row_number`` is any unique column that follows source order.
    """
    filled = null_to_empty(canonical_null(df, na_tokens))
    groups = duplicate_groups(filled, rules, row_number, exclude)
    # The sample comes from a join on the unique row number: carrying it through the
    # aggregate would turn that into a sort and move every row's text.
    samples = filled.select(
        F.col(row_number).alias("sample_row_number"),
        *[
            (F.col(f"`{c}`") if c in filled.columns else F.lit("")).alias(f"sample_{c}")
            for c in sample_cols
        ],
    )
    report = groups.join(samples, "sample_row_number")
    report = report.select(
        "duplicate_type",
        "duplicate_key",
        "duplicate_count",
        "sample_row_number",
        *[f"sample_{c}" for c in sample_cols],
    )
    by_size = ["duplicate_type", F.desc("duplicate_count"), "sample_row_number"]
    return report.orderBy(*by_size) if ordered else report


def _extra_rows():
    size = F.coalesce(F.col("duplicate_count").try_cast("bigint"), F.lit(0))
    return size, F.greatest(size - 1, F.lit(0))


def duplicate_summary(report: DataFrame, with_max: bool = False) -> DataFrame:
    """Groups and surplus rows per rule; with the largest group on request."""
    size, extra = _extra_rows()
    by_type = report.groupBy("duplicate_type")
    if with_max:
        return by_type.agg(
            F.count(F.lit(1)).alias("groups"),
            F.max(size).alias("max_group_size"),
            F.sum(extra).alias("rows_flagged"),
        ).orderBy("duplicate_type")
    return by_type.agg(
        F.count(F.lit(1)).alias("duplicate_groups"),
        F.sum(extra).alias("duplicate_rows_flagged"),
    ).orderBy(F.desc("duplicate_rows_flagged"), "duplicate_type")


def total_flagged(report: DataFrame) -> DataFrame:
    """Surplus rows over all rules."""
    _, extra = _extra_rows()
    return report.agg(F.coalesce(F.sum(extra), F.lit(0)).alias("total_flagged"))
