"""Missing values, column roles and types, remediation plan, report summaries."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fettle.functions.labels import count_label, recommend
from fettle.functions.nulls import NA_TOKENS, is_blank, is_missing, is_na_token, strip
from fettle.functions.rows import as_rows
from fettle.functions.shapes import (
    BOOLEAN_WORDS,
    DATE_LAYOUTS,
    INTEGER_PATTERN,
    NUMBER_NOISE,
    NUMBER_PATTERN,
    float_text,
)
from fettle.sources.tables import existing, sample_rows

# Limits for column roles.
DATE_NAME_RATE = 0.5
SHAPE_RATE = 0.9
DATE_MIN_LENGTH = 8
NUMBER_MAX_LENGTH = 20
DATE_HINTS = ("date", "start", "end")
TEXT_HINTS = ("name", "title", "description")


def missing_cell(c: Column, dtype: T.DataType, na_tokens: Iterable[str] = NA_TOKENS) -> Column:
    """True when a cell is null, a null token or blank."""
    if isinstance(dtype, T.StringType):
        return c.isNull() | is_na_token(c, na_tokens) | is_blank(c)
    return is_missing(c, dtype)


def missing_counts(df: DataFrame, na_tokens: Iterable[str] = NA_TOKENS) -> DataFrame:
    """One row per column: ordinal, column, missing_count, total, percent (unrounded)."""
    tokens = list(na_tokens)
    fields = df.schema.fields
    # One aggregate over one scan gives a single row; only that row is unpivoted.
    totals = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[
            F.count_if(missing_cell(F.col(f"`{f.name}`"), f.dataType, tokens)).alias(f"_{i}")
            for i, f in enumerate(fields)
        ],
    )
    cells = as_rows(
        ["ordinal", "column", "missing_count"],
        [(F.lit(i), F.lit(f.name), F.col(f"_{i}")) for i, f in enumerate(fields)],
    )
    share = F.col("missing_count") / F.col("total") * 100
    return totals.select("total", cells).withColumn(
        "percent", F.when(F.col("total") > 0, share).otherwise(F.lit(0.0))
    )


def missing_report(
    df: DataFrame, na_tokens: Iterable[str] = NA_TOKENS, ordered: bool = True
) -> DataFrame:
    """Missing values and a recommendation for every column, worst first."""
    report = missing_counts(df, na_tokens).select(
        F.col("column").alias("colonne"),
        F.col("missing_count").alias("valeurs_manquantes"),
        F.col("total").alias("total_lignes"),
        F.round("percent", 2).alias("pourcentage_manquant"),
        recommend(F.col("percent")).alias("recommandation"),
    )
    worst = [F.desc("pourcentage_manquant"), F.desc("valeurs_manquantes"), "colonne"]
    return report.orderBy(*worst) if ordered else report


def _incomplete(df: DataFrame, na_tokens: Iterable[str]) -> DataFrame:
    return missing_counts(df, na_tokens).where("missing_count > 0").select(
        "ordinal", "column", "missing_count", F.round("percent", 2).alias("missing_percent")
    )


def missing_profile(df: DataFrame, na_tokens: Iterable[str] = NA_TOKENS) -> DataFrame:
    """The incomplete columns, worst first, ties in table order."""
    return (
        _incomplete(df, na_tokens)
        .orderBy(F.desc("missing_percent"), F.desc("missing_count"), "ordinal")
        .drop("ordinal")
    )


def completeness(df: DataFrame, na_tokens: Iterable[str] = NA_TOKENS) -> DataFrame:
    """How many columns are incomplete and complete."""
    return missing_counts(df, na_tokens).agg(
        F.count_if(F.col("missing_count") > 0).alias("incomplete_columns"),
        F.count_if(F.col("missing_count") == 0).alias("complete_columns"),
        F.count(F.lit(1)).alias("total_columns"),
    )


def remediation_plan(df: DataFrame, policies: Sequence, default, na_tokens=NA_TOKENS) -> DataFrame:
    """The treatment proposed for each incomplete column, worst first."""
    rows = [
        (column, p.decision, p.treatment, p.reason) for p in policies for column in p.columns
    ]
    policy = df.sparkSession.createDataFrame(
        rows, "column string, decision string, treatment string, reason string"
    )
    # Both sides have at most one row per table column.
    return (
        _incomplete(df, na_tokens)
        .join(F.broadcast(policy), "column", "left")
        .orderBy(F.desc("missing_percent"), F.desc("missing_count"), "ordinal")
        .select(
            "column",
            count_label(F.col("missing_count"), F.col("missing_percent")).alias("missing"),
            F.coalesce("decision", F.lit(default.decision)).alias("recommended decision"),
            F.coalesce("treatment", F.lit(default.treatment)).alias("exact future treatment"),
            F.coalesce("reason", F.lit(default.reason)).alias("business rationale"),
        )
    )


# What is known of a cell is one number: a bit for each of these, then the lengths of its text,
# of it as a whole number and as a floating one.
_BITS = ("present", "integers", "numbers", "booleans", "shown", "dates", "shapes")
_SHORT_DECIMAL = r"^-?(?!0\.000)(0|[1-9]\d{0,8})\.\d{1,6}$"
_LENGTHS = {"text_length": (7, 30), "integer_length": (37, 8), "float_length": (45, 16)}


def _may_be_number(c: Column) -> Column:
    """False only if text cannot be a number, also without noise: by its first character."""
    return (c < ":") | c.startswith("i") | c.startswith("I")


def _cell_facts(cells: DataFrame, na_tokens: Iterable[str]) -> DataFrame:
    """(ordinal, fact, odd) of cells (ordinal, raw), each worked out once in a few steps.

    Patterns are for the few cells whose first character allows for them. A number that is
    printed otherwise than it stands is odd: its text is kept, for its length as printed.
    """

    def bit(test: Column, name: str) -> Column:
        return F.when(test, 1 << _BITS.index(name)).otherwise(0)

    value, bare, shown, number = F.col("value"), F.col("bare"), F.col("shown"), F.col("number")
    cells = cells.select("ordinal", F.when(~is_na_token(F.col("raw"), na_tokens), F.col("raw")).alias("value"))
    cells = cells.select("*", strip(value).alias("trimmed"), F.btrim(value, F.lit(" \t\r\n\x0b\x0c")).alias("bare"))
    cells = cells.select(
        "ordinal",
        "value",
        "bare",
        F.when(F.col("trimmed") != "", F.col("trimmed")).alias("shown"),
        (_may_be_number(bare) & bare.rlike(NUMBER_PATTERN)).alias("number"),
    )
    cells = cells.select("*", F.when(number & bare.rlike(INTEGER_PATTERN), bare.try_cast("bigint")).alias("integer"))
    cells = cells.select("*", F.char_length(F.col("integer").cast("string")).alias("digits"))
    noise = reduce(or_, [shown.contains(c) for c in NUMBER_NOISE])
    shaped = F.when((bare == shown) & ~noise, number).otherwise(
        strip(F.translate(shown, NUMBER_NOISE, "")).rlike(NUMBER_PATTERN)
    )
    bits = {
        "present": value.isNotNull(),
        "integers": F.col("integer").isNotNull(),
        "numbers": number,
        "booleans": value.isin(*BOOLEAN_WORDS),
        "shown": shown.isNotNull(),
        "dates": shown.between("0", ":") & shown.rlike("|".join(DATE_LAYOUTS)),
        "shapes": _may_be_number(shown) & shaped,
    }
    # Below 10^15 a whole number is shown with a point and a zero after it, and a short decimal
    # as it stands, without zeros at its end.
    cut = F.rtrim(bare, F.lit("0"))
    lengths = {
        "text_length": F.char_length(shown),
        "integer_length": F.col("digits"),
        "float_length": F.when((F.abs("integer") < 10**15) & ~bare.startswith("-0"), F.col("digits") + 2).when(
            number & bare.rlike(_SHORT_DECIMAL), F.char_length(cut) + F.when(cut.endswith("."), 1).otherwise(0)
        ),
    }
    fact = F.lit(0).cast("bigint")
    for name, test in bits.items():
        fact = fact + bit(test, name)
    for name, length in lengths.items():
        fact = fact + F.shiftleft(F.coalesce(length, F.lit(0)).cast("bigint"), _LENGTHS[name][0])
    cells = cells.select("ordinal", "bare", "number", fact.alias("fact"))
    odd = F.when(number & (F.shiftright("fact", _LENGTHS["float_length"][0]) == 0), bare)
    return cells.select("ordinal", "fact", odd.alias("odd"))


def _column_stats(
    df: DataFrame, order: str, n: int | None, na_tokens: Iterable[str]
) -> DataFrame:
    """A row of counts per column over all rows, or the first n.

    Cells are worked out to one number, and equal ones are counted in each task before the
    shuffle: a histogram of lengths and shapes per column, which merges, and from which all
    counts and medians follow.
    """
    names = df.columns
    rows = df if n is None else sample_rows(df, n, order)
    text = F.array(*[F.col(f"`{c}`").cast("string") for c in names])
    cells = rows.select(F.posexplode(text).alias("ordinal", "raw"))
    counts = _cell_facts(cells, na_tokens).groupBy("ordinal", "fact", "odd").agg(F.count(F.lit(1)).alias("n"))
    printed = F.char_length(float_text(F.col("odd").try_cast("double"))).cast("bigint")
    known = F.col("fact") + F.shiftleft(F.coalesce(printed, F.lit(0).cast("bigint")), _LENGTHS["float_length"][0])
    counts = counts.select("ordinal", "n", known.alias("fact"))
    times, fact = F.col("n"), F.col("fact")

    def count(name: str) -> Column:
        return F.coalesce(F.sum(F.when(fact.bitwiseAND(1 << _BITS.index(name)) != 0, times)), F.lit(0)).alias(name)

    def median(name: str) -> Column:
        """Of the lengths above zero; an empty text is not shown."""
        at, size = _LENGTHS[name]
        length = F.shiftright(fact, at).bitwiseAND((1 << size) - 1)
        return F.percentile(F.when(length > 0, length), 0.5, times).alias(name)

    totals = counts.groupBy("ordinal").agg(F.sum("n").alias("rows"), *map(count, _BITS), *map(median, _LENGTHS))
    # A table without rows still has its columns.
    listed = df.sparkSession.createDataFrame(list(enumerate(names)), "ordinal int, column string")
    found = listed.join(totals, "ordinal", "left").na.fill(0, ["rows", *_BITS])
    rate = {r: F.when(F.col("shown") > 0, F.col(n) / F.col("shown")) for r, n in (("date_rate", "dates"), ("number_rate", "shapes"))}
    return found.withColumns({**rate, "detected_dtype": _dtype()})


def _dtype() -> Column:
    full = F.col("present") == F.col("rows")
    return (
        F.when(F.col("present") == 0, "float64")
        .when(full & (F.col("integers") == F.col("present")), "int64")
        .when(F.col("numbers") == F.col("present"), "float64")
        .when(full & (F.col("booleans") == F.col("present")), "bool")
        .otherwise("object")
    )


def column_dtypes(
    df: DataFrame, order: str, n: int | None = None, na_tokens=NA_TOKENS
) -> DataFrame:
    """Detected storage type of each column, from all rows or the first n."""
    return (
        _column_stats(df, order, n, list(na_tokens))
        .orderBy("ordinal")
        .select("column", "detected_dtype")
    )


def column_roles(
    df: DataFrame, order: str, n: int | None = None, na_tokens=NA_TOKENS
) -> DataFrame:
    """Role of each column (numeric, text or date), from all rows or the first n."""
    name = F.lower("column")

    def named(hints: Sequence[str]) -> Column:
        return name.rlike("|".join(hints))

    # A numeric column is shown as its type prints it: 123 with a gap in the column is 123.0.
    length = (
        F.when(F.col("detected_dtype") == "int64", F.col("integer_length"))
        .when(F.col("detected_dtype") == "float64", F.col("float_length"))
        .otherwise(F.col("text_length"))
    )
    date_rate = F.when(named(DATE_HINTS), F.col("date_rate")).otherwise(F.lit(0.0))
    is_date = F.when(named(["date"]), date_rate >= DATE_NAME_RATE).otherwise(
        (date_rate >= SHAPE_RATE) & (length >= DATE_MIN_LENGTH)
    )
    is_number = (
        (F.col("number_rate") >= SHAPE_RATE) & ~named(TEXT_HINTS) & (length <= NUMBER_MAX_LENGTH)
    )
    role = (
        F.when(F.col("shown") == 0, "text")
        .when(is_date, "date")
        .when(is_number, "numeric")
        .otherwise("text")
    )
    return (
        _column_stats(df, order, n, list(na_tokens))
        .orderBy("ordinal")
        .select("column", role.alias("role"))
    )


def value_profile(df: DataFrame, cols: Sequence[str], top: int = 12) -> DataFrame:
    """The most frequent values of each column, null shown as ``<missing>``.

    Counts are combined before the ranking, which keeps only ``top`` rows per column
    in each task before it shuffles.
    """
    cells = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols]).unpivot(
        [], [F.col(f"`{c}`") for c in cols], "column", "value"
    )
    counts = cells.groupBy("column", F.coalesce("value", F.lit("<missing>")).alias("value")).agg(
        F.count(F.lit(1)).alias("count")
    )
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("count"), "value"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= top)


# The columns of a report whose values are counted.
SUMMARY_COLUMNS = ("decision", "status", "duplicate_type", "recommandation")


def report_summary(
    report: DataFrame, cols: Sequence[str] = SUMMARY_COLUMNS, top: int = 12
) -> DataFrame:
    """Rows, column list and most frequent values of a report: column, value, count, rank.

    The first two are shown as columns ``<rows>`` and ``<columns>``; wanted columns that the
    report lacks are left out.
    """
    listed = [
        (F.lit("<rows>"), F.lit(None).cast("string"), F.col("_n"), F.lit(1)),
        (F.lit("<columns>"), F.lit(", ".join(report.columns)), F.lit(len(report.columns)).cast("bigint"), F.lit(1)),
    ]
    size = report.agg(F.count(F.lit(1)).alias("_n"))
    size = size.select(as_rows(["column", "value", "count", "rank"], listed))
    shown = existing(report, cols)
    return size.unionByName(value_profile(report, shown, top)) if shown else size
