"""Summary metrics over the whole run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fettle.functions.rows import as_rows
from fettle.operators.duplicates import total_flagged
from fettle.operators.mapping import changed, effective, review_count


def _metric(name: str, df: DataFrame, column: str) -> DataFrame:
    return df.select(F.lit(name).alias("metric"), F.col(column).cast("bigint").alias("value"))


def name_metrics(raw: DataFrame, mapping: DataFrame | None, target: str) -> DataFrame:
    """Rows, distinct raw and cleaned names, and corrections.

    Rows are counted by name first; the mapping is joined to the counts, never to the table,
    and all figures follow from them.
    """
    name = F.col(f"`{target}`")
    counts = raw.groupBy(name.alias("raw")).agg(F.count(F.lit(1)).alias("n"))
    if mapping is None:
        pairs = counts.withColumn("clean", F.lit(None).cast("string"))
    else:
        found = counts.join(effective(mapping), F.col("raw") == F.col("original_value"), "left")
        pairs = found.select("raw", "n", F.coalesce("clean_value", "raw").alias("clean"))
    moved = F.when(changed(F.col("raw"), F.col("clean")), F.col("n")).otherwise(0)
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        # There is one row for each raw name.
        F.count("raw").alias("distinct_raw"),
        F.count_distinct("clean").alias("distinct_clean"),
        F.coalesce(F.sum(moved), F.lit(0)).alias("corrections_applied"),
    )


def final_summary(
    raw: DataFrame, duplicates: DataFrame, mapping: DataFrame, target: str, cleaned: bool = True
) -> DataFrame:
    """Metric and value for the whole run; without a cleaned table its metrics are 0."""
    names = name_metrics(raw, mapping if cleaned else None, target)
    fields = ["rows", "distinct_raw", "distinct_clean", "corrections_applied"]
    listed = names.select(
        as_rows(
            ["metric", "value"],
            [
                *[(F.lit(f), F.col(f).cast("bigint")) for f in fields],
                (F.lit("columns"), F.lit(len(raw.columns)).cast("bigint")),
            ],
        )
    )
    return listed.unionByName(
        _metric("duplicate_rows_flagged", total_flagged(duplicates), "total_flagged")
    ).unionByName(_metric("corrections_review", review_count(mapping), "review_rows"))
