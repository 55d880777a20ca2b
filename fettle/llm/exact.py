"""Exact dedup by distributed radix partitioning from the most significant byte.

Documents are split by successive runs of bytes. After each round a group is done when it
has a single document or its texts have ended; only the others go on, each with what is
left of its text. Texts are told apart by their bytes alone, never by a digest. The runs
grow eightfold a round, so long texts need few rounds.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fettle.llm.common import stored

FIRST_RUN = 256
GROWTH = 8


def normalised(text):
    """Lower-cases A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def exact_groups(docs: DataFrame, first_run: int = FIRST_RUN, growth: int = GROWTH) -> DataFrame:
    """For each document keep_id, group_size and kept; of equal texts the largest id stays.

    Also gives text_sha256 of the normalised text, which plays no part in the comparison.
    Null and empty texts are equal. Of rows with equal text that share the largest id one
    stays. Null ids sort first. Columns other than doc_id and text are not read; an empty
    table gives an empty result.

    A round counts its groups before the shuffle and joins the counts back, so that a hot
    group, which is one row of counts, leaves its documents to be split over tasks.
    """
    spark = docs.sparkSession
    text = normalised(F.col("text"))
    # The length is the first key: texts of other lengths are never equal, and all texts of
    # a group end in the same round.
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.sha2(text, 256)).alias("sha"),
        F.encode(text, "utf-8").alias("rest"),
    )
    rows = rows.withColumn("size", F.octet_length("rest")).withColumn("part", F.col("size").cast("long"))
    first, run, ended, done = True, first_run, 0, []
    while True:
        now = F.substring("rest", 1, run)
        if first:
            # Ids of rows exist from the first written table on.
            counts = rows.groupBy("part", now.alias("run")).agg(F.count(F.lit(1)).alias("members"))
        else:
            counts = rows.groupBy("part", now.alias("run")).agg(
                F.count(F.lit(1)).alias("members"), F.min("row").alias("id"), F.max(F.struct("doc_id", "row")).alias("top")
            )
        counts = counts.select(F.col("part").alias("_part"), F.col("run").alias("_run"), *counts.columns[2:])
        met = rows.join(counts, (F.col("part") == F.col("_part")) & (now == F.col("_run")))
        ended += run
        if first:
            met = met.withColumn("row", F.monotonically_increasing_id())
            kept_text = F.when(F.col("members") > 1, F.col("rest"))
            met = stored(met.select("doc_id", "sha", "size", "part", "members", "row", kept_text.alias("rest")), "radix")
            # Groups of the first round are split again with their row ids known.
            done.append(met.where("members = 1").select("doc_id", "sha", F.col("doc_id").alias("keep_id"),
                                                        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")))
            rows, ended, first = met.where("members > 1").drop("members"), 0, False
            continue
        over = (F.col("size") <= ended) | (F.col("members") == 1)
        rest = F.when(~over, F.expr(f"substring(rest, {run + 1})"))
        met = stored(
            met.select("doc_id", "sha", "size", F.col("id").alias("part"), "members", "row", "top", over.alias("over"), rest.alias("rest")),
            "radix",
        )
        done.append(
            met.where("over").select(
                "doc_id", "sha", F.col("top.doc_id").alias("keep_id"), F.col("members").alias("group_size"),
                (F.col("top.row") == F.col("row")).alias("kept"),
            )
        )
        rows = met.where("not over").select("doc_id", "sha", "size", "part", "row", "rest")
        if rows.isEmpty():
            break
        run *= growth
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))
