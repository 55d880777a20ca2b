"""Line dedup by site-relative frequency, in DataFrame functions only.

A line is boilerplate on a host when the pages of that host that contain it are more than a
given part of all pages of the host. Lines are compared without the blanks around them;
blank lines are kept and never counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fettle.llm.common import stored

RATIO = 0.1
LEAST_PAGES = 3


def _digest(line):
    """128 bits of a line: two hashes from different seeds."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b"))


def boilerplate(
    pages: DataFrame, host: str, text: str, ratio: float, least: int, copies_once: bool = False
) -> DataFrame:
    """Per host the digests of its boilerplate lines.

    With ``copies_once`` equal texts of a host are one page. They are put together by their
    digest before the lines are taken apart, and combine before the shuffle.

    The digests of one page are made distinct before they leave its row, so a page counts
    once without a shuffle of its own. The list of a host is short whatever the number of
    its pages: its lines hold more than ``ratio`` of the pages each, so there are at most
    (mean distinct lines a page) / ratio of them.
    """
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    digests = F.array_distinct(F.transform(lines, lambda x: _digest(F.trim(x))))
    rows = pages.select(F.col(host).alias("_host"), digests.alias("_lines"), _digest(F.col(text)).alias("_page"))
    sites = rows.select(F.col("_host").alias("_site"), "_page")
    if copies_once:
        rows = rows.groupBy("_host", "_page").agg(F.any_value("_lines").alias("_lines"))
        sites = sites.distinct()
    seen = rows.select("_host", F.explode("_lines").alias("_line"))
    counts = seen.groupBy("_host", "_line").agg(F.count(F.lit(1)).alias("_pages"))
    totals = sites.groupBy("_site").agg(F.count(F.lit(1)).alias("_total"))
    common = counts.where(F.col("_pages") >= least).join(totals, F.col("_host").eqNullSafe(F.col("_site")))
    common = common.where(F.col("_pages") > F.col("_total") * ratio)
    return common.groupBy("_host").agg(F.collect_list("_line").alias("_drop"))


def drop_boilerplate(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    least: int = LEAST_PAGES,
    copies_once: bool = False,
) -> DataFrame:
    """All columns with the text that is left, and n_lines, n_dropped (in place of any such).

    A line goes when more than ``ratio`` of the host's pages, and ``least`` pages at least,
    contain it. A null text stays null with no lines; a null host is a host of its own; each
    of several equal rows is a page. Rows are never dropped: a page may end up empty. With
    ``copies_once`` rows of equal text are one page of their host, so that the copies of a
    text do not make its lines boilerplate; a stage that removes copies can come after.
    """
    # Written first: its size is then known when the join is planned, and where it is small
    # the pages need no shuffle.
    found = boilerplate(pages, host, text, ratio, least, copies_once).withColumnRenamed("_host", "_site")
    found = stored(found, "boilerplate")
    pages = pages.drop("n_lines", "n_dropped")
    # Columns travel as one, so that none is taken for a column of the steps below.
    whole = F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("_row")
    rows = pages.select(whole, F.col(host).alias("_host"), F.col(text).alias("_text"))
    joined = rows.join(found, F.col("_host").eqNullSafe(F.col("_site")), "left")
    lines = F.split("_text", "\n")
    kept = F.when(F.col("_drop").isNull(), lines).otherwise(
        F.filter(lines, lambda x: ~F.array_contains(F.col("_drop"), _digest(F.trim(x))))
    )
    n_lines = F.coalesce(F.size(lines), F.lit(0))
    kept_n = F.coalesce(F.size("_kept"), F.lit(0))
    left = F.array_join("_kept", "\n")
    columns = [(left if c == text else F.col("_row").getField(c)).alias(c) for c in pages.columns]
    return joined.withColumn("_kept", kept).select(
        *columns, n_lines.alias("n_lines"), (n_lines - kept_n).alias("n_dropped")
    )
