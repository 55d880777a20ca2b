from collections import Counter, defaultdict

import pytest
from helpers import SCHEMA, awkward, awkward_rows, empty, words

from fettle.llm import exact

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """(doc_id, keep_id, group_size) and how many of each are kept."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = Counter()
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        out.update((i, keep, len(ids)) for i in ids)
    return out, len(groups)


def check(df, rows):
    got = df.collect()
    want, groups = brute(rows)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == want
    kept = [r for r in got if r["kept"]]
    assert len(kept) == groups and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_awkward_rows(spark):
    check(exact.exact_groups(awkward(spark)), [(r[0], r[1]) for r in awkward_rows()])


@pytest.mark.parametrize("first_run, growth", [(1, 2), (7, 3), (256, 8)])
def test_runs(spark, first_run, growth):
    base = words(5, 200)
    texts = [base, base.upper(), base + "x", base[:-1] + "!", "é" + base, "É" + base, base[:50], base[:50], "é", "É"] * 3
    texts += [base[:i] + "#" + base[i + 1 :] for i in (0, 3, 500, 900)]
    rows = list(enumerate(texts))
    check(exact.exact_groups(spark.createDataFrame(rows, "doc_id long, text string"), first_run, growth), rows)


def test_hot_group(spark):
    rows = [(i, "Hot text" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    check(exact.exact_groups(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_empty(spark):
    assert exact.exact_groups(empty(spark)).count() == 0
    assert SCHEMA
