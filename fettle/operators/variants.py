"""Spelling variants of names: value counts, compact groups, canonical labels, scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fettle.functions import text
from fettle.functions.alias import DEFAULT_FAMILIES, AliasFamily, accept_label, review_label
from fettle.functions.fuzzy import compact_similarity, decision, repeat_similarity
from fettle.functions.rows import computed_once
from fettle.functions.text import compact_text


def value_counts(df: DataFrame, target: str, order: str | None = None) -> DataFrame:
    """Rows per distinct non-null value; with the first row in source order on request."""
    first = [F.min(order).alias("first_row")] if order else []
    value = F.col(f"`{target}`")
    return (
        df.where(value.isNotNull())
        .groupBy(value.alias("original_value"))
        .agg(F.count(F.lit(1)).alias("count"), *first)
    )


def _distinct_text(c: Column, dtype: T.DataType) -> Column:
    """Text that is equal where values are."""
    if isinstance(dtype, T.BinaryType):
        return F.hex(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(c == 0, F.lit("0.0")).otherwise(c.cast("string"))
    return c.cast("string") if isinstance(dtype, T.AtomicType) else F.to_json(F.struct(c))


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact number of distinct non-null values of each column.

    Cells become pairs of ordinal and value, of which each task keeps the distinct ones before
    the only shuffle; a value that holds a third of the rows is one pair a task.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    pairs = [F.struct(F.lit(i).alias("ordinal"), _distinct_text(F.col(f"`{c}`"), kinds[c]).alias("value")) for i, c in enumerate(cols)]
    found = df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull()).distinct()
    return found.agg(*[F.count_if(F.col("ordinal") == i).alias(c) for i, c in enumerate(cols)])


def name_forms(values: DataFrame) -> DataFrame:
    """Add normal forms to distinct values; values without a letter or digit are dropped.

    ``normalized_value`` and ``compact_value`` come from the collapsed text and decide the
    group; ``full_normalized`` comes from the whole text and is what scores compare.
    """
    forms = F.inline(F.array(text.name_forms(F.col("original_value"))))
    blank, none = F.lit(" "), F.lit("")
    named = values.select("*", forms).where(F.col("normalized_value") != "")
    return named.select(
        "*",
        F.replace("normalized_value", blank, none).alias("compact_value"),
        F.replace("full_normalized", blank, none).alias("full_compact"),
    )


def compact_groups(
    forms: DataFrame, families: Sequence[AliasFamily] = DEFAULT_FAMILIES
) -> DataFrame:
    """One row per compact form: members, canonical label, accepted family if any member has one.

    The canonical label is the most frequent spelling, then the shortest normal form,
    then the first in alphabet, then the first in the source. Computed as an aggregate,
    so a form shared by very many spellings is combined in each task before the shuffle.
    """
    whole = F.col("full_normalized")
    best_first = F.struct(-F.col("count"), F.char_length(whole), whole, F.col("first_row"))
    label = F.struct("original_value", F.char_length("full_compact").alias("length"))
    return (
        forms.groupBy("compact_value")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.min_by(label, best_first).alias("best"),
            F.min(accept_label(F.col("normalized_value"), families)).alias("group_family"),
        )
        .select(
            "compact_value",
            "members",
            F.col("best.original_value").alias("canonical"),
            F.col("best.length").alias("canonical_length"),
            "group_family",
        )
    )


def scored_names(
    values: DataFrame, families: Sequence[AliasFamily] = DEFAULT_FAMILIES
) -> DataFrame:
    """Suggested label, score and decision for each value that has a variant or an alias."""
    forms = name_forms(values)
    groups = compact_groups(forms, families)
    normalized, full, key = F.col("normalized_value"), F.col("full_compact"), F.col("compact_value")
    accepted, review = F.col("accepted_family"), F.col("review_family")
    # One row per form on the right: a form with very many spellings only makes the left
    # side uneven, which adaptive execution splits. It can do so where both sides are
    # shuffled for the join; with the length, which the text implies, as part of the key,
    # the partitioning of the groups by text alone does not stand in for that shuffle.
    length = F.octet_length("compact_value").alias("compact_length")
    tagged = forms.select("*", length).join(
        groups.select("*", length), ["compact_value", "compact_length"]
    ).select(
        "*",
        accept_label(normalized, families).alias("accepted_family"),
        review_label(normalized, families).alias("review_family"),
    )
    grouped = F.col("members") > 1
    alias = F.when(grouped, F.col("group_family")).otherwise(review)
    admitted = tagged.where(accepted.isNotNull() | grouped | review.isNotNull()).select(
        "*",
        alias.alias("alias"),
        F.coalesce(accepted, alias, F.col("canonical")).alias("suggested_group"),
        (F.char_length(full) / F.char_length(key)).cast("int").alias("repeats"),
        (F.col("canonical_length") / F.char_length(key)).cast("int").alias("label_repeats"),
        compact_text(alias).alias("label"),
    )
    score = (
        F.when(accepted.isNotNull(), F.lit(100))
        # Inside a group every spelling repeats the same compact form.
        .when(
            F.col("alias").isNull(), repeat_similarity(F.col("repeats"), F.col("label_repeats"))
        )
        .when(F.col("label") == key, repeat_similarity(F.col("repeats"), F.lit(1)))
        .otherwise(compact_similarity(full, F.col("label")))
    )
    # Keeping the first row here gives both sides of the join the same value counts, so the
    # table is scanned and shuffled once for both.
    once = computed_once(score.alias("similarity_score"), F.col("first_row").alias("seen_first"))
    scored = admitted.select("*", once)
    return scored.withColumn("decision", decision(F.col("similarity_score")))


def decision_rank(c: Column) -> Column:
    """Order of decisions in reports: accepted, review, rejected."""
    return F.when(c == "accepted", 0).when(c == "review", 1).otherwise(2)


def variants_report(
    df: DataFrame,
    target: str,
    order: str = "row_number",
    families: Sequence[AliasFamily] = DEFAULT_FAMILIES,
) -> DataFrame:
    """Spelling variants with suggestion, score and decision, in no order.

    All text work is done on distinct values, after the counts. ``report_order`` sorts the
    report where it is shown or written; the mapping and all counts do without.
    """
    return scored_names(value_counts(df, target, order), families).select(
        "original_value",
        "normalized_value",
        "suggested_group",
        "similarity_score",
        "count",
        "decision",
    )


def report_order() -> list[Column | str]:
    """Order of the variants report: decision, most rows first, name."""
    return [decision_rank(F.col("decision")), F.desc("count"), "original_value"]


def decision_counts(report: DataFrame) -> DataFrame:
    """Rows per decision, most frequent first."""
    return (
        report.groupBy("decision")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "decision")
    )
