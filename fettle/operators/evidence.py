"""Evidence for a question: sections, relevant rows, lookups, metrics, bounded text."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fettle.functions.nulls import strip
from fettle.functions.rows import beside
from fettle.functions.shapes import exact_sum, to_number
from fettle.functions.tokens import (
    STOP_WORDS,
    TOKEN_PATTERN,
    any_contains,
    fold_case,
    words_found,
)
from fettle.operators.profile import SUMMARY_COLUMNS, report_summary
from fettle.operators.search import clip_cells, first_rows
from fettle.sources.tables import existing

# Sizes of the evidence.
SECTION_CHARS = 2_800
HEADING_CHARS = 250
HEADING_BONUS = 2
BUDGET_CHARS = 26_000
SEPARATOR = "\n\n"
QUESTION_TOKENS = 10

# Where a section starts.
HEADING_PATTERN = r"^#{1,3}\s"

# The columns shown for a lookup.
LOOKUP_COLUMNS = (
    "ref_number",
    "recipient_legal_name",
    "recipient_legal_name_clean",
    "recipient_country",
    "recipient_province",
    "recipient_city",
    "agreement_value",
    "agreement_start_date",
    "agreement_end_date",
    "owner_org",
)

# The figures quoted in a summary text.
METRIC_PATTERNS = {
    "raw_rows": r"Original rows: ([0-9,]+)",
    "columns": r"Columns: ([0-9,]+)",
    "unique_raw_orgs": r"Unique raw organization names: ([0-9,]+)",
    "unique_clean_orgs": r"Unique cleaned organization names: ([0-9,]+)",
    "corrections_applied": r"Corrections applied in the cleaned file: ([0-9,]+)",
    "corrections_review": r"Corrections left for review: ([0-9,]+)",
    "duplicate_rows_flagged": r"Total duplicate rows flagged across rules: ([0-9,]+)",
}


def question_tokens(question: str) -> list[str]:
    """Words of a question, lower case, in order, without repeats and stop words."""
    words = (w.lower() for w in re.findall(TOKEN_PATTERN, question))
    return list(dict.fromkeys(w for w in words if w not in STOP_WORDS))


def split_sections(
    df: DataFrame, source: Sequence[str], text: str, label: str, n: int = SECTION_CHARS
) -> DataFrame:
    """Split texts before headings, then into windows of n characters.

    Adds section and part (both from 1), label and chunk to the source columns. The part
    of a text before its first heading is section 1, so a text that starts with a heading
    starts at section 2.
    """
    content = F.col(f"`{text}`")
    # Unix lines and Unicode white space: a heading follows a line feed or starts the text.
    flags, blank = "(?mdU)", r"[\s\x1c-\x1f]"
    heading = HEADING_PATTERN.replace(r"\s", blank)
    skipped = F.when(content.rlike("(?U)" + heading), F.lit(2)).otherwise(F.lit(1))
    sections = df.select(
        *source,
        skipped.alias("_skipped"),
        F.posexplode(F.split(content, f"{flags}(?={heading})")).alias("_nth", "_raw"),
    ).select(
        *source, (F.col("_nth") + F.col("_skipped")).alias("section"), strip(F.col("_raw")).alias("_body")
    )
    starts = F.sequence(F.lit(1), F.char_length("_body"), F.lit(n))
    return (
        sections.where(F.col("_body") != "")
        .select(*source, "section", "_body", F.posexplode(starts).alias("_part", "_start"))
        .select(
            *source,
            "section",
            (F.col("_part") + 1).alias("part"),
            F.format_string("%s section %d", F.col(label).cast("string"), "section").alias("label"),
            F.substr("_body", "_start", F.lit(n)).alias("chunk"),
        )
    )


def section_score(
    chunk: Column, tokens: Sequence[str], heading_chars: int = HEADING_CHARS
) -> Column:
    """Question words found in a chunk, plus a bonus when one is near its start."""
    if not tokens:
        return F.lit(0)
    overlap = words_found(chunk, tokens)
    start = fold_case(F.substring(chunk, 1, heading_chars))
    near_start = F.lit(False)
    for token in tokens:
        near_start = near_start | start.contains(token)
    return overlap + F.when(near_start, HEADING_BONUS).otherwise(0)


def top_sections(
    sections: DataFrame, source: Sequence[str], question: str, k: int = 2
) -> DataFrame:
    """The k best chunks of each source; earlier chunks win ties, zero scores stay.

    The rank filter lets each task keep k chunks per source before the shuffle.
    """
    best = Window.partitionBy(*source).orderBy(F.desc("score"), "section", "part")
    return (
        sections.withColumn("score", section_score(F.col("chunk"), question_tokens(question)))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
    )


def relevant_rows(
    report: DataFrame,
    question: str,
    k: int = 6,
    order: Sequence[Column | str] = (),
    cols: Sequence[str] | None = None,
    words: int = QUESTION_TOKENS,
) -> DataFrame:
    """The k rows that contain most of the first ``words`` question words, cells clipped."""
    cols = list(cols if cols is not None else report.columns)
    cells = [F.col(f"`{c}`").cast("string") for c in cols]
    score = F.lit(0)
    for token in question_tokens(question)[:words]:
        score = score + any_contains(cells, token).cast("int")
    best = (
        report.withColumn("_score", score)
        .where(F.col("_score") > 0)
        .orderBy(F.desc("_score"), *order)
        .limit(k)
    )
    return clip_cells(best.select(*cols, "_score")).withColumn(
        "score", F.col("_score").cast("int")
    ).drop("_score")


def budget_concat(
    items: DataFrame, order: Sequence[str], text: str = "text", budget: int = BUDGET_CHARS
) -> DataFrame:
    """Join texts in order until a character budget is used up; the last one is clipped.

    ``order`` must be a unique key; a null text takes no part. Each text costs its length plus the separator, so at
    most budget / 2 + 1 texts can take part: only that many keys and lengths, without the
    texts, reach the running total. The texts of the few that fit are then looked up, each
    cut to what is left, so one task never holds more than the budget in characters.
    """
    cost = len(SEPARATOR)
    items = items.where(F.col(text).isNotNull())
    lengths = items.select(*order, F.char_length(text).alias("_size"))
    first = lengths.orderBy(*order).limit(budget // cost + 1)
    in_order = Window.orderBy(*order)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum(F.col("_size") + cost).over(earlier), F.lit(0))
    fitting = first.select(
        *order, F.row_number().over(in_order).alias("_nth"), (F.lit(budget) - used).alias("_left")
    ).where(F.col("_left") > 0)
    # At most budget / 2 + 1 rows of a key and two numbers.
    cut = F.substr(F.col(text), F.lit(1), F.col("_left").cast("int"))
    clipped = items.join(F.broadcast(fitting), list(order)).select("_nth", cut.alias("_text"))
    listed = F.sort_array(F.collect_list(F.struct("_nth", "_text")))
    return clipped.agg(
        F.array_join(listed["_text"], SEPARATOR).alias("text"), F.count(F.lit(1)).alias("items")
    )


def enough_documents(
    docs: DataFrame,
    key: str,
    items: Callable[[DataFrame], DataFrame],
    budget: int = BUDGET_CHARS,
    first: int = 32,
    growth: int = 4,
) -> DataFrame:
    """The first documents by key whose items use up a character budget, or all of them.

    ``items`` makes the column ``text`` from some of the documents. Ever larger blocks are
    tried, each made of the keys up to one that is found by the keys alone; a table stored in
    their order is read no further. An item costs its length and the separator, so blocks
    end before there are budget / 2 documents with items.
    """
    n = first
    while True:
        # The largest of the n smallest keys comes to the driver, with their number.
        found = docs.select(key).orderBy(key).limit(n).agg(F.max(key), F.count(key)).first()
        if found[1] < n:
            return docs
        block = docs.where(F.col(key) <= found[0])
        used = items(block).agg(F.sum(F.char_length("text") + len(SEPARATOR))).first()[0]
        if (used or 0) >= budget:
            return block
        n *= growth


def _item(df: DataFrame, part: int, text: Column, place: Column | None = None) -> DataFrame:
    """Rows as evidence: part and place order them."""
    where = F.lit(0) if place is None else place
    return df.select(F.lit(part).alias("part"), where.cast("bigint").alias("place"), text.alias("text"))


def figures_item(figures: DataFrame, part: int, title: str) -> DataFrame:
    """A single row of figures as text, one line for each."""
    lines = [F.concat(F.lit(f"{c}: "), F.col(f"`{c}`").cast("string")) for c in figures.columns]
    return _item(figures, part, F.concat_ws("\n", F.lit(f"[{title}]"), *lines))


def summary_item(report: DataFrame, part: int, name: str, top: int = 12) -> DataFrame:
    """``report_summary`` as text; an empty report says so. At most ``top`` values a column."""
    is_rows, is_columns = F.col("column") == "<rows>", F.col("column") == "<columns>"
    counted = F.concat("value", F.lit("="), F.format_number("count", 0))
    lines = (
        report_summary(report, SUMMARY_COLUMNS, top)
        .groupBy("column")
        .agg(
            F.max(F.when(is_rows, F.col("count"))).alias("_n"),
            F.max(F.when(is_columns, F.col("value"))).alias("_columns"),
            F.sort_array(F.collect_list(F.struct("rank", counted.alias("shown")))).alias("_values"),
        )
    )
    listed = F.concat(F.col("column"), F.lit(" counts: "), F.array_join(F.col("_values")["shown"], ", "))
    place = F.array_position(F.array(*[F.lit(c) for c in SUMMARY_COLUMNS]), F.col("column"))
    whole = lines.agg(
        F.max("_n").alias("n"),
        F.max("_columns").alias("columns"),
        F.sort_array(F.collect_list(F.when(place > 0, F.struct(place.alias("place"), listed.alias("line"))))).alias("lines"),
    )
    first = F.concat(F.lit(f"[{name}] Rows: "), F.format_number("n", 0), F.lit("; columns: "), F.col("columns"))
    text = F.when(F.col("n") == 0, F.lit(f"[{name}] Report is missing or empty.")).otherwise(
        F.concat_ws("\n", first, F.col("lines")["line"])
    )
    return _item(whole, part, text)


def rows_item(
    report: DataFrame, part: int, name: str, question: str, order: Sequence[str], k: int = 6
) -> DataFrame:
    """The k most relevant rows of a report as text; nothing if no row has a question word."""
    cols = report.columns
    found = relevant_rows(report, question, k, order, cols)
    line = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in cols])
    best = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("first"), *order, line.alias("line"))))
    text = F.concat_ws("\n", F.lit(f"[{name} relevant rows]"), F.lit(",".join(cols)), F.col("best")["line"])
    return _item(found.agg(best.alias("best")).where(F.size("best") > 0), part, text)


def section_text() -> Column:
    """A section as it is quoted."""
    return F.concat(F.lit("["), "label", F.lit("]\n"), "chunk")


def gather_evidence(
    question: str,
    figures: DataFrame,
    totals: DataFrame,
    reports: Sequence[tuple[str, DataFrame, Sequence[str]]],
    sections: DataFrame,
    section_order: str,
) -> DataFrame:
    """All evidence for a question: part, place, text.

    In this order: the figures, the lookup, then for each report its summary and relevant
    rows, then the best sections (as ``top_sections`` gives them).
    """
    items = [figures_item(figures, 0, "project metrics"), figures_item(totals, 1, "dataset lookup")]
    for n, (name, report, order) in enumerate(reports, 1):
        items.append(summary_item(report, 2 * n, name))
        items.append(rows_item(report, 2 * n + 1, name, question, order))
    place = F.col(section_order) * 100 + F.col("rank")
    items.append(_item(sections, 2 * len(reports) + 2, section_text(), place))
    return reduce(DataFrame.unionByName, items)


def evidence_bundle(
    items: DataFrame, sources: Sequence[str], totals: DataFrame, budget: int = BUDGET_CHARS
) -> DataFrame:
    """Bounded text, the names of the reports consulted and the number of rows matched.

    ``items`` are those of ``gather_evidence``, ``totals`` the row of ``lookup_totals``.
    """
    matched = totals.select(F.col("matched_rows").alias("dataset_rows"))
    text = budget_concat(items, ["part", "place"], budget=budget).select("text")
    return beside(text, matched).select("text", F.array(*[F.lit(s) for s in sources]).alias("sources"), "dataset_rows")


def _has_term(df: DataFrame, term: str, cols: Sequence[str]) -> Column:
    return any_contains([F.col(f"`{c}`").cast("string") for c in existing(df, cols)], term)


def lookup_totals(
    df: DataFrame,
    term: str,
    cols: Sequence[str] = LOOKUP_COLUMNS,
    value_col: str = "agreement_value",
) -> DataFrame:
    """Rows that contain the term and the sum of their values; without a term, zeros.

    Ordinary values are summed in decimals, so the order of addition does not matter.
    """
    if not term:
        return df.sparkSession.range(1).select(
            F.lit(0).cast("bigint").alias("matched_rows"), F.lit(0.0).alias("value_sum")
        )
    value = to_number(F.col(f"`{value_col}`").cast("string"))
    return df.where(_has_term(df, term, cols)).agg(
        F.count(F.lit(1)).alias("matched_rows"),
        exact_sum(value).alias("value_sum"),
    )


def lookup_rows(
    df: DataFrame,
    term: str,
    cols: Sequence[str] = LOOKUP_COLUMNS,
    n: int = 8,
    order: str = "row_number",
    numbered: bool = False,
) -> DataFrame:
    """The first rows, in source order, that contain the term; without a term, none.

    ``numbered`` says that the table is stored in that order: then no more of it is read, from
    the start, than holds n such rows.
    """
    shown = existing(df, cols)
    if not term:
        return df.select(*shown).limit(0)
    return first_rows(df, _has_term(df, term, cols), order, n, numbered).select(*shown)


def extract_metrics(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """Figures quoted in summary texts, one column each; 0 when a figure is absent."""
    found = []
    for name, pattern in METRIC_PATTERNS.items():
        digits = F.replace(F.regexp_extract(F.col(f"`{text}`"), pattern, 1), F.lit(","), F.lit(""))
        found.append(F.coalesce(digits.try_cast("bigint"), F.lit(0)).alias(name))
    return df.select(*keep, *found)
