"""Recommendations, reasons and display labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fettle.functions.alias import DEFAULT_FAMILIES, AliasFamily

# What to do with a column, by its share of missing cells.
NOTHING_TO_DO = "Rien à faire"
SIMPLE_FILL = "Imputation simple"
FILL_AND_FLAG = "Imputation + colonne is_missing"
ASSESS_COLUMN = "Évaluer l'utilité de la colonne"
DROP_CANDIDATE = "Suppression possible, sauf valeur métier importante"

# Why a proposed spelling was accepted, held for review or rejected.
FULL_NAME = "nom complet reconnu"
ACRONYM = "forme évidente ou acronymie équivalente"
SAME_COMPACT = "même forme compacte après normalisation"
VALIDATED_PREFIX = "variante validée vers "
STRONG_BUT_CHECK = "forte similarité mais validation recommandée"
AMBIGUOUS = "possible faute de frappe ou variante ambiguë"
OTHER_CONTEXT = "contexte potentiellement distinct autour de "
CLOSE_BUT_CHECK = "proposition proche mais à vérifier"
CONFIRM_BY_HAND = "similarité à confirmer manuellement"
TOO_DIFFERENT = "similarité insuffisante ou contexte différent"


def recommend(percent: Column) -> Column:
    """Treatment for a column, from the unrounded percentage of missing cells."""
    return (
        F.when(percent == 0, F.lit(NOTHING_TO_DO))
        .when(percent < 5, F.lit(SIMPLE_FILL))
        .when(percent <= 40, F.lit(FILL_AND_FLAG))
        .when(percent <= 70, F.lit(ASSESS_COLUMN))
        .otherwise(F.lit(DROP_CANDIDATE))
    )


def count_label(n: Column, percent: Column) -> Column:
    """Display text such as ``1,234 (5.60%)``."""
    return F.format_string("%,d (%.2f%%)", n, percent)


def accepted_reason(
    normalized: Column,
    accepted: Column,
    clean_value: Column,
    score: Column,
    families: Sequence[AliasFamily] = DEFAULT_FAMILIES,
) -> Column:
    """Why a mapping was accepted; ``normalized`` is the whole, uncollapsed text."""
    full = [name for f in families for name in f.full_names]
    acronyms = [name for f in families for name in f.acronyms]
    return (
        F.when(accepted & normalized.isin(full), F.lit(FULL_NAME))
        .when(accepted & normalized.isin(acronyms), F.lit(ACRONYM))
        .when(score >= 100, F.lit(SAME_COMPACT))
        .otherwise(F.concat(F.lit(VALIDATED_PREFIX), clean_value))
    )


def review_reason(
    normalized: Column,
    candidate: Column,
    score: Column,
    families: Sequence[AliasFamily] = DEFAULT_FAMILIES,
) -> Column:
    """Why a mapping waits for a person; ``normalized`` is the whole, uncollapsed text."""
    compact = F.replace(normalized, F.lit(" "), F.lit(""))
    reason = F.when(candidate & (score >= 90), F.lit(STRONG_BUT_CHECK)).when(
        candidate, F.lit(AMBIGUOUS)
    )
    for f in families:
        reason = reason.when(compact.contains(f.label), F.lit(OTHER_CONTEXT + f.label))
    return reason.when(score >= 80, F.lit(CLOSE_BUT_CHECK)).otherwise(F.lit(CONFIRM_BY_HAND))
