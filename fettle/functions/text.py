"""Text normalisation: accent folding, compact form, repeated segments."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from fettle.functions.nulls import strip

_FIRST_NON_ASCII = 0x80
_LAST_FOLDABLE = 0x20000  # nothing above this plane folds to A-Z or 0-9


def _fold(char: str) -> str:
    """What one code point becomes: upper case, compatibility form, marks dropped, rest blank."""
    decomposed = unicodedata.normalize("NFKD", char.upper())
    bare = [p for p in decomposed if not unicodedata.combining(p)]
    return "".join(p if p.isascii() and p.isalnum() and not p.islower() else " " for p in bare)


@lru_cache(maxsize=1)
def fold_tables() -> tuple[str, str, dict[str, str]]:
    """Translation tables from Unicode data: (from, to) for one-to-one, a dict for the rest.

    Code points past the end of ``to`` in ``from`` are deleted (combining marks).
    Those that only fold to blanks are left out: the final clean-up blanks them anyway,
    except in the punctuation blocks of everyday prose, where blanking them here keeps
    the text pure ASCII and off the expansion path.
    """
    single, target, removed, expanded = [], [], [], {}
    for cp in range(_FIRST_NON_ASCII, _LAST_FOLDABLE):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        char = chr(cp)
        folded = _fold(char)
        if folded == "":
            removed.append(char)
        elif folded.strip() == "":
            if cp <= 0xBF or 0x2000 <= cp <= 0x206F:
                single.append(char)
                target.append(" ")
        elif len(folded) == 1:
            single.append(char)
            target.append(folded)
        else:
            expanded[char] = folded
    return "".join(single + removed), "".join(target), expanded


@lru_cache(maxsize=1)
def _expansion_class() -> str:
    """The expanded code points as one regular-expression class, written as ranges."""
    points = sorted(ord(c) for c in fold_tables()[2])
    ranges: list[list[int]] = []
    for p in points:
        if ranges and p == ranges[-1][1] + 1:
            ranges[-1][1] = p
        else:
            ranges.append([p, p])
    return "".join(rf"\x{{{lo:x}}}-\x{{{hi:x}}}" for lo, hi in ranges)


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def _is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def _expand(c: Column) -> Column:
    """Replace the code points that fold to more than one character."""
    cls = _expansion_class()
    pairs = F.str_to_map(
        F.lit(",".join(f"{k}:{v}" for k, v in fold_tables()[2].items())), F.lit(","), F.lit(":")
    )
    runs = F.regexp_extract_all(c, F.lit(f"([^{cls}]+|[{cls}])"), F.lit(1))
    folded = F.transform(runs, lambda r: F.coalesce(F.try_element_at(pairs, r), r))
    return F.when(c.rlike(f"[{cls}]"), F.array_join(folded, "")).otherwise(c)


def _folded_upper(c: Column) -> Column:
    """Upper-case text with accents folded; other symbols may remain."""
    source, target, _ = fold_tables()
    # Sharp s is the one expansion frequent in prose: do it without the expansion path.
    translated = F.translate(F.replace(c, F.lit("ß"), F.lit("ss")), source, target)
    folded = bind(translated, lambda t: F.when(_is_ascii(t), t).otherwise(_expand(t)))
    return F.upper(F.when(_is_ascii(c), c).otherwise(folded))


def normalize_text(c: Column) -> Column:
    """Upper-case A-Z 0-9 words separated by single blanks; null gives the empty string."""
    cleaned = F.regexp_replace(_folded_upper(F.coalesce(c, F.lit(""))), "[^A-Z0-9]+", " ")
    return F.trim(cleaned)


def compact_text(c: Column) -> Column:
    """Normalised text without blanks."""
    return F.regexp_replace(_folded_upper(F.coalesce(c, F.lit(""))), "[^A-Z0-9]+", "")


def name_forms(c: Column) -> Column:
    """Struct of the forms of a name: collapsed text, its normal form, and that of the whole text.

    When all segments split by ``|`` or ``/`` agree, the collapsed text is the first one;
    otherwise it is the trimmed text.
    """

    def forms(collapsed: Column, normalized: Column, whole: Column) -> Column:
        return F.struct(
            collapsed.alias("collapsed_value"),
            normalized.alias("normalized_value"),
            whole.alias("full_normalized"),
        )

    def plain(text: Column) -> Column:
        return bind(normalize_text(text), lambda n: forms(text, n, n))

    def segmented(text: Column) -> Column:
        parts = F.filter(F.transform(F.split(text, "[|/]"), strip), lambda p: p != "")

        def choose(found: Column) -> Column:
            def agree(norms: Column) -> Column:
                # Separators count as blanks, so the whole text repeats the normal form.
                same = forms(found[0], norms[0], F.trim(F.array_join(norms, " ")))
                is_repeat = (F.size(norms) > 1) & (F.size(F.array_distinct(norms)) == 1)
                return F.when(is_repeat, same).otherwise(plain(text))

            return bind(F.transform(found, normalize_text), agree)

        return bind(parts, choose)

    def either(text: Column) -> Column:
        has_separator = text.contains("|") | text.contains("/")
        return F.when(has_separator, segmented(text)).otherwise(plain(text))

    return bind(strip(F.coalesce(c, F.lit(""))), either)


def collapse_segments(c: Column) -> Column:
    """First of the segments split by ``|`` or ``/`` when all agree, else the trimmed text."""
    return name_forms(c)["collapsed_value"]
