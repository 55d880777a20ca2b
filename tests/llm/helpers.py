"""Small tables with the awkward cases that every operator has to handle."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `_block` string, sequence_id string"


def words(seed: int, n: int, kinds: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""
    long = words(1, 30_000, 5_000)
    texts = [
        None,
        "",
        " ",
        "\n\n",
        "one",
        "A B c",
        "a b C",
        long,
        long,
        long.upper(),
        long + " tail",
        "line\n" * 50,
        "ünï çødé\n 　 ß",
        words(2, 300),
        words(2, 300) + "\n" + words(3, 300),
    ]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, len(t or ""), "x", "y") for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], rows[7]]  # repeated
    rows.append((None, None, None, None, None, None, None))
    rows.append((None, "no id", None, "s1", 5, None, None))
    return rows


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
