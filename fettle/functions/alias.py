"""Alias families: known spellings of one entity, and spellings that need a person."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from fettle.functions.text import name_forms


@dataclass(frozen=True)
class AliasFamily:
    """One entity: its label, the accepted and reviewable forms, and a short-form stem."""

    label: str
    accept: tuple[str, ...]
    full_names: tuple[str, ...] = ()
    review: tuple[str, ...] = ()
    stem: str = ""
    max_len: int = 0

    @property
    def acronyms(self) -> tuple[str, ...]:
        return tuple(a for a in self.accept if a not in self.full_names)


# The one alias family of the grants table, in normalised form.
DEFAULT_FAMILIES = (
    AliasFamily(
        label="UQAM",
        accept=("UQAM", "U Q A M", "UNIVERSITE DU QUEBEC A MONTREAL"),
        full_names=("UNIVERSITE DU QUEBEC A MONTREAL",),
        review=("AQAM", "QAM", "COOP UQAM"),
        stem="QAM",
        max_len=12,
    ),
)


def first_label(tests: Sequence[tuple[Column, str]]) -> Column:
    """Label of the first test that holds, else null."""
    label = F.lit(None).cast("string")
    for test, name in reversed(tests):
        label = F.when(test, F.lit(name)).otherwise(label)
    return label


def accept_label(normalized: Column, families: Sequence[AliasFamily] = DEFAULT_FAMILIES) -> Column:
    """Label of the family that accepts a normalised, collapsed value; null if none does."""
    return first_label([(normalized.isin(list(f.accept)), f.label) for f in families])


def review_label(normalized: Column, families: Sequence[AliasFamily] = DEFAULT_FAMILIES) -> Column:
    """Label of the family for which a normalised, collapsed value needs review."""
    compact = F.replace(normalized, F.lit(" "), F.lit(""))
    tests = []
    for f in families:
        test = normalized.isin(list(f.review)) if f.review else F.lit(False)
        if f.stem:
            short_form = (F.char_length(compact) <= f.max_len) & compact.contains(f.stem)
            test = test | (short_form & ~normalized.isin(list(f.accept)))
        tests.append(((normalized != "") & test, f.label))
    return first_label(tests)


def accept_alias(c: Column, families: Sequence[AliasFamily] = DEFAULT_FAMILIES) -> Column:
    """True when raw text is an accepted spelling."""
    return accept_label(name_forms(c)["normalized_value"], families).isNotNull()


def review_candidate(c: Column, families: Sequence[AliasFamily] = DEFAULT_FAMILIES) -> Column:
    """True when raw text looks like an alias but needs a person to decide."""
    return review_label(name_forms(c)["normalized_value"], families).isNotNull()
