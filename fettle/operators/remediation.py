"""Carry out the remediation policy: curated rows, rows for review, checks, audit."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fettle.functions.nulls import NA_TOKENS, canonical_null
from fettle.functions.rows import as_rows, beside
from fettle.functions.shapes import date_shape, numeric_shape
from fettle.operators.profile import missing_cell, missing_profile
from fettle.operators.policies import (
    DEFAULT_POLICY,
    DEPENDENT_DATE,
    DEPENDENT_FILL,
    DROP,
    FILL,
    POLICIES,
    STATUS,
    Policy,
)

REVIEW = "needs_review"

# Names of actions in the audit and the log.
SENT_TO_REVIEW = "SENT TO REVIEW"
DROPPED_VALUE = "DROPPED VALUE"
DROPPED_COLUMN = "DROPPED COLUMN"
# Of what should not be.
WRONG_VALUE = "UNEXPECTED VALUE"
NO_COLUMN = "MISSING COLUMN"
EXTRA_COLUMN = "EXTRA COLUMN"
NOT_DROPPED = "NOT DROPPED"
LOST_ROW = "LOST ROW"
ADDED_ROW = "ADDED ROW"
REPEATED_ROW = "REPEATED ROW"


def unlisted_incomplete(df: DataFrame, policies: Sequence[Policy] = POLICIES) -> list[str]:
    """Incomplete columns that no policy lists. Runs the profile: one name per column returns."""
    listed = {c for p in policies for c in p.columns}
    return [r["column"] for r in missing_profile(df).collect() if r["column"] not in listed]


def policy_by_column(
    columns: Iterable[str], policies: Sequence[Policy], unlisted: Sequence[str] = ()
) -> dict[str, Policy]:
    """The policy of each treated column, in table order."""
    listed = {c: p for p in policies for c in p.columns}
    listed.update({c: replace(DEFAULT_POLICY, columns=(c,)) for c in unlisted if c not in listed})
    return {c: listed[c] for c in columns if c in listed}


def _dependent_value(p: Policy) -> Column:
    """Fill value by the column it depends on; an unknown dependency counts as expected."""
    differs = F.coalesce(F.col(f"`{p.depends_on}`") != p.expected, F.lit(False))
    return F.when(differs, F.lit(p.fill)).otherwise(F.lit(p.otherwise))


def _is_unamended(p: Policy) -> Column:
    return F.coalesce(F.col(f"`{p.depends_on}`").try_cast("bigint") == int(p.expected), F.lit(False))


def _treated(name: str, p: Policy | None) -> list[Column]:
    """Output columns for one input column."""
    cell = F.col(f"`{name}`")
    if p is None:
        return [cell]
    missing = cell.isNull()
    if p.kind == DROP:
        return []
    if p.kind == STATUS:
        return [cell, F.when(missing, F.lit(p.fill)).alias(f"{name}_status")]
    if p.kind == DEPENDENT_DATE:
        status = F.when(missing & _is_unamended(p), F.lit(p.fill))
        return [cell, status.alias(f"{name}_status")]
    value = _dependent_value(p) if p.kind == DEPENDENT_FILL else F.lit(p.fill)
    out = [F.coalesce(cell.cast("string"), value).alias(name)]
    if p.keep_raw:
        out.append(cell.alias(f"{name}_raw"))
    if p.flag:
        out.append(missing.alias(f"{name}_was_missing"))
    return out


def _needs_review(chosen: dict[str, Policy]) -> Column:
    """An amendment without its date."""
    tests = [
        F.col(f"`{name}`").isNull() & ~_is_unamended(p)
        for name, p in chosen.items()
        if p.kind == DEPENDENT_DATE
    ]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def remediate(
    df: DataFrame,
    policies: Sequence[Policy] = POLICIES,
    unlisted: Sequence[str] = (),
    na_tokens: Iterable[str] = NA_TOKENS,
) -> DataFrame:
    """Every row treated, with a ``needs_review`` mark; one pass, no shuffle.

    ``unlisted`` names incomplete columns without a policy; they get the default one.
    """
    clean = canonical_null(df, na_tokens)
    chosen = policy_by_column(df.columns, policies, unlisted)
    out = [c for name in df.columns for c in _treated(name, chosen.get(name))]
    return clean.select(*out, _needs_review(chosen).alias(REVIEW))


def curated_rows(treated: DataFrame) -> DataFrame:
    """Treated rows that are fit for use."""
    return treated.where(~F.col(REVIEW)).drop(REVIEW)


def review_rows(
    df: DataFrame, policies: Sequence[Policy] = POLICIES, na_tokens: Iterable[str] = NA_TOKENS
) -> DataFrame:
    """Rows held back for a person, as they came."""
    clean = canonical_null(df, na_tokens)
    return clean.where(_needs_review(policy_by_column(df.columns, policies)))


def _profiles(
    before: DataFrame, treated: DataFrame, chosen: dict[str, Policy], na_tokens: Iterable[str]
) -> tuple[list[Column], list[Column], list[tuple[str, Column, Column, Column]]]:
    """Missing values of rows not held for review, by column of the table before.

    Aggregates over the clean table before and over the treated rows, then for each column its
    name and, of their results, the number before, after and as it should be: none where cells
    are filled, a dropped column has none, and all others keep theirs.
    """
    held, kinds = _needs_review(chosen), {f.name: f.dataType for f in treated.schema.fields}
    first, then, listed = [], [], []
    for i, name in enumerate(before.columns):
        first.append(F.count_if(F.col(f"`{name}`").isNull() & ~held).alias(f"_was_{i}"))
        dropped = name in chosen and chosen[name].kind == DROP
        filled = name in chosen and chosen[name].kind in (FILL, DEPENDENT_FILL)
        after = F.lit(0).cast("bigint")
        if name in kinds:
            missing = missing_cell(F.col(f"`{name}`"), kinds[name], na_tokens)
            then.append(F.count_if(missing & ~F.col(REVIEW)).alias(f"_is_{i}"))
            after = F.col(f"_is_{i}")
        expected = F.lit(0).cast("bigint") if dropped or filled else F.col(f"_was_{i}")
        listed.append((name, F.col(f"_was_{i}"), after, expected))
    return first, then, listed


def remediation_profile(
    before: DataFrame,
    treated: DataFrame,
    policies: Sequence[Policy] = POLICIES,
    unlisted: Sequence[str] = (),
    na_tokens: Iterable[str] = NA_TOKENS,
) -> DataFrame:
    """The missing-value profile before and after treatment, side by side, in table order.

    Per column the missing cells of the rows not held for review before, after, and as they
    should be. One aggregate over each table.
    """
    chosen = policy_by_column(before.columns, policies, unlisted)
    first, then, listed = _profiles(before, treated, chosen, na_tokens)
    both = beside(canonical_null(before, na_tokens).agg(*first), treated.agg(*then) if then else treated.agg(F.count(F.lit(1)).alias("_n")))
    rows = [(F.lit(name), *figures) for name, *figures in listed]
    return both.select(as_rows(["column", "before", "after", "expected"], rows))


def remediation_checks(
    before: DataFrame,
    treated: DataFrame,
    policies: Sequence[Policy] = POLICIES,
    unlisted: Sequence[str] = (),
    numeric: Sequence[str] = ("agreement_value", "foreign_currency_value", "amendment_number"),
    dates: Sequence[str] = ("amendment_date", "agreement_start_date", "agreement_end_date"),
    na_tokens: Iterable[str] = NA_TOKENS,
) -> DataFrame:
    """Failures per check: rows kept, cells filled, types kept, dependencies respected, and the
    missing values of each column as they should be now.

    Two aggregates: one over the table before, and one over the treated rows.
    """
    chosen = policy_by_column(before.columns, policies, unlisted)
    review, names = F.col(REVIEW), set(treated.columns)

    def failures(test: Column) -> Column:
        return F.count_if(~review & F.coalesce(test, F.lit(False)))

    checks: dict[str, Column] = {}
    for name, p in chosen.items():
        cell = F.col(f"`{name}`")
        if p.kind == DROP:
            checks[f"dropped:{name}"] = F.max(F.lit(int(name in names)))
        elif p.kind in (FILL, DEPENDENT_FILL):
            checks[f"populated:{name}"] = failures(cell.isNull())
        elif p.kind == STATUS:
            status = F.col(f"`{name}_status`")
            checks[f"status:{name}"] = failures(cell.isNull() != status.isNotNull())
        elif p.kind == DEPENDENT_DATE:
            status = F.col(f"`{name}_status`")
            checks[f"status:{name}"] = failures(cell.isNull() != status.isNotNull())
        if p.kind == DEPENDENT_FILL:
            outside = F.col(f"`{p.depends_on}`") == p.expected
            checks[f"dependency:{name}"] = failures((cell == p.fill) & outside)
    for name in numeric:
        if name in names:
            cell = F.col(f"`{name}`").cast("string")
            checks[f"type:{name}"] = failures(cell.isNotNull() & ~numeric_shape(cell))
    for name in dates:
        if name in names:
            cell = F.col(f"`{name}`").cast("string")
            checks[f"type:{name}"] = failures(cell.isNotNull() & ~date_shape(cell))

    missing_before, missing_after, profile = _profiles(before, treated, chosen, na_tokens)
    totals = treated.agg(
        F.count_if(~review).alias("_curated"),
        F.count_if(review).alias("_review"),
        *missing_after,
        *[c.cast("bigint").alias(f"_{i}") for i, c in enumerate(checks.values())],
    )
    listed = [
        (F.lit(name), F.coalesce(F.col(f"_{i}"), F.lit(0))) for i, name in enumerate(checks)
    ]
    listed += [(F.lit(f"profile:{name}"), F.abs(after - expected)) for name, _, after, expected in profile]
    clean = canonical_null(before, na_tokens)
    kept = beside(totals, clean.agg(F.count(F.lit(1)).alias("_before"), *missing_before))
    lost = F.abs(F.col("_before") - F.col("_curated") - F.col("_review"))
    return kept.select(
        as_rows(["check", "failures"], [(F.lit("row_conservation"), lost), *listed])
    )


def _actions(name: str, p: Policy) -> list[tuple[str, Column]]:
    """What happens to a cell: (action, test) pairs."""
    cell = F.col(f"`{name}`")
    missing = cell.isNull()
    if p.kind == DROP:
        return [(DROPPED_VALUE, cell.isNotNull())]
    if p.kind == DEPENDENT_DATE:
        unamended = _is_unamended(p)
        return [
            (f"STATUS {p.fill}", missing & unamended),
            (SENT_TO_REVIEW, missing & ~unamended),
        ]
    if p.kind == STATUS:
        return [(f"STATUS {p.fill}", missing)]
    if p.kind == DEPENDENT_FILL:
        value = _dependent_value(p)
        return [
            (f"FILLED {p.fill}", missing & (value == p.fill)),
            (f"FILLED {p.otherwise}", missing & (value == p.otherwise)),
        ]
    return [(f"FILLED {p.fill}", missing)]


def _steps(chosen: dict[str, Policy]) -> list[tuple[str, str, Column]]:
    """(column, action, test) of all that is done; rows held for review are left as they came."""
    held = _needs_review(chosen)
    return [
        (name, action, test if action == SENT_TO_REVIEW else test & ~held)
        for name, p in chosen.items()
        for action, test in _actions(name, p)
    ]


def planned_changes(
    df: DataFrame,
    policies: Sequence[Policy] = POLICIES,
    unlisted: Sequence[str] = (),
    na_tokens: Iterable[str] = NA_TOKENS,
) -> DataFrame:
    """Cells that the policy touches per column and action; one aggregate over one scan.

    Counts what the curated table should show, and the cells that send a row to review. A
    dropped column is listed whether it had values or not, with their number.
    """
    clean = canonical_null(df, na_tokens)
    steps = _steps(policy_by_column(df.columns, policies, unlisted))
    totals = clean.agg(*[F.count_if(test).alias(f"_{i}") for i, (_, _, test) in enumerate(steps)])
    return totals.select(_listed(steps)).where(_SHOWN)


_SHOWN = "cells > 0 or action = 'DROPPED COLUMN'"


def _listed(steps: list[tuple[str, str, Column]], more: Sequence[tuple[Column, Column, Column]] = ()) -> Column:
    """Rows (column, action, cells) from the counts of all steps."""
    rows = [
        (F.lit(n), F.lit(DROPPED_COLUMN if a == DROPPED_VALUE else a), F.col(f"_{i}"))
        for i, (n, a, _) in enumerate(steps)
    ]
    return as_rows(["column", "action", "cells"], [*rows, *more])


def _result_column(name: str, action: str) -> str:
    """The treated column that shows an action."""
    if action == SENT_TO_REVIEW:
        return REVIEW
    return f"{name}_status" if action.startswith("STATUS ") else name


def remediation_audit(
    before: DataFrame,
    after: DataFrame | None = None,
    policies: Sequence[Policy] = POLICIES,
    unlisted: Sequence[str] = (),
    row_number: str = "row_number",
    na_tokens: Iterable[str] = NA_TOKENS,
) -> DataFrame:
    """What was done to each cell, from the table before and the treated table after.

    Rows are matched by number, and every cell that the policy gives is compared with the one
    that is there. Counted per column and action are the treatments that the treated table
    shows, and as actions of their own cells with another value than they should have, columns
    that lack, that are too many or were not dropped, and, with no column, rows that were lost,
    added, or are there again. Without ``after`` the treatments are those the policy plans.

    Row numbers are unique before. After, one may come often: its rows are streamed past the
    one row before, a join that is split where a number holds many rows; rows lost are found by
    an anti join of the numbers alone.
    """
    if after is None:
        return planned_changes(before, policies, unlisted, na_tokens)
    clean = canonical_null(before, na_tokens)
    chosen = policy_by_column(before.columns, policies, unlisted)
    steps = _steps(chosen)
    treated = [c for name in before.columns for c in _treated(name, chosen.get(name))]
    names = [*clean.select(*treated).columns, REVIEW]
    wanted = zip(names, [*treated, _needs_review(chosen)], strict=True)
    was = clean.select("*", *[c.alias(f"_want_{n}") for n, c in wanted])
    there = after.select(F.col(f"`{row_number}`").alias("_number"), *[F.col(f"`{n}`").alias(f"_is_{n}") for n in after.columns])
    met = there.join(was, F.col("_number") == F.col(f"`{row_number}`"), "left")
    known = F.col(f"`{row_number}`").isNotNull()

    def right(name: str) -> Column:
        if name not in after.columns:
            return F.lit(False)
        return F.col(f"`_is_{name}`").cast("string").eqNullSafe(F.col(f"`_want_{name}`").cast("string"))

    # A dropped column has no cell to compare: it is looked for among the columns.
    shown = [known & (test if a == DROPPED_VALUE else test & right(_result_column(n, a))) for n, a, test in steps]
    shared = [n for n in names if n in after.columns]
    extra = [n for n in after.columns if n not in names]
    totals = met.agg(
        *[F.count_if(F.coalesce(t, F.lit(False))).alias(f"_{i}") for i, t in enumerate(shown)],
        *[F.count_if(known & ~right(n)).alias(f"_wrong_{i}") for i, n in enumerate(shared)],
        *[F.count_if(F.col(f"`_is_{n}`").isNotNull()).alias(f"_extra_{i}") for i, n in enumerate(extra)],
        F.count_if(known).alias("_met"),
        F.count_if(~known).alias("_added"),
    )
    numbers = before.select(F.col(f"`{row_number}`").alias("_was"))
    missed = numbers.join(there.select("_number"), F.col("_was") == F.col("_number"), "left_anti")
    figures = beside(
        beside(totals, missed.agg(F.count(F.lit(1)).alias("_lost"))), numbers.agg(F.count(F.lit(1)).alias("_all"))
    )
    whole = F.lit(None).cast("string")
    more = [(F.lit(n), F.lit(WRONG_VALUE), F.col(f"_wrong_{i}")) for i, n in enumerate(shared)]
    more += [(F.lit(n), F.lit(NO_COLUMN), F.col("_met")) for n in names if n not in after.columns]
    more += [
        (F.lit(n), F.lit(NOT_DROPPED if n in before.columns else EXTRA_COLUMN), F.col(f"_extra_{i}"))
        for i, n in enumerate(extra)
    ]
    more += [
        (whole, F.lit(LOST_ROW), F.col("_lost")),
        (whole, F.lit(ADDED_ROW), F.col("_added")),
        (whole, F.lit(REPEATED_ROW), F.col("_met") - (F.col("_all") - F.col("_lost"))),
    ]
    kept = [f"(`column` = '{n}' and action = '{DROPPED_COLUMN}')" for n in extra]
    return figures.select(_listed(steps, more)).where(_SHOWN).where(f"not ({' or '.join(['false', *kept])})")


def remediation_log(
    df: DataFrame,
    policies: Sequence[Policy] = POLICIES,
    unlisted: Sequence[str] = (),
    row_number: str = "row_number",
    na_tokens: Iterable[str] = NA_TOKENS,
) -> DataFrame:
    """One row per touched cell: row number, column, action. Map-only."""
    clean = canonical_null(df, na_tokens)
    chosen = policy_by_column(df.columns, policies, unlisted)
    entries = [
        F.when(test, F.struct(F.lit(n).alias("column"), F.lit(action).alias("action")))
        for n, action, test in _steps(chosen)
    ]
    return clean.select(row_number, F.inline(F.array_compact(F.array(*entries))))
