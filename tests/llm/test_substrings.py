import re
from collections import Counter

import numpy as np
import pytest
from helpers import awkward, awkward_rows, empty, words
from hypothesis import given, settings
from hypothesis import strategies as st

from fettle.llm import exchange, substrings


def brute(rows, window):
    """(doc_id, n_words, n_removed, kept) of each row."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    seen = Counter(tuple(w[k : k + window]) for _, w in split for k in range(len(w) - window + 1))
    out = Counter()
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone.update(range(k, k + window))
        out[i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)] += 1
    return out


def result(df):
    return Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in df.collect())


def test_awkward_rows(spark):
    for limit in (1, 4_000_000):
        got = substrings.remove_repeats(awkward(spark), batch_bytes=limit)
        assert result(got) == brute([(r[0], r[1]) for r in awkward_rows()], 35)


@pytest.mark.parametrize("window", [5, 12, 35])
def test_shared_passages(spark, window):
    shared = [words(50 + i, n) for i, n in enumerate((window - 1, window, window + 1, 3 * window, 200))]
    rows = []
    for i in range(300):
        parts = [words(1000 + i, 20 + i % 17, 3000), shared[i % 5], words(2000 + i, i % 40, 3000)]
        rows.append((i, " ".join(parts)))
    rows += [(900, "again " * 100), (901, "x " + "again " * (window - 1)), (902, words(7, 60) + " " + words(7, 60)), (903, "\x1cone\xa0two\x0bthree")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert result(substrings.remove_repeats(docs, window, batch_bytes=5_000)) == brute(rows, window)


def test_windows_with_one_key_are_told_apart(spark):
    """With keys that all agree only the second number tells windows apart."""
    rows = [(1, "a b " + words(1, 60)), (2, words(2, 60)), (3, words(1, 60) + " c"), (4, words(3, 35)), (5, words(4, 90))]
    texts = [[w.encode() for w in t.split()] for _, t in rows]
    flat, ends = exchange.word_hashes(texts)
    keys = np.zeros(len(flat), np.uint64)
    places, _ = exchange.starts(ends, 35)
    other = exchange.rolling(exchange.mixed(flat ^ substrings._SECOND), 35)[places] >> np.uint64(33)
    _, which, counts = substrings._distinct(keys[places], other)
    found = {int(p) for p in places[counts[which] > 1]}
    want = Counter(tuple(t[k : k + 35]) for t in texts for k in range(len(t) - 34))
    begins = [0, *ends[:-1].tolist()]
    assert found == {b + k for t, b in zip(texts, begins) for k in range(len(t) - 34) if want[tuple(t[k : k + 35])] > 1}
    assert result(substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows, 35)


def test_spans(spark):
    rows = [(1, "a b " + words(1, 40)), (2, words(1, 40) + " c")]
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [(2, 42)], 2: [(0, 40)]}


def test_empty(spark):
    assert substrings.remove_repeats(empty(spark)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=60), st.integers(1, 40))
def test_rolling_hash_depends_on_the_window_alone(values, length):
    flat = np.array(values, np.uint64)
    got = exchange.rolling(flat, length)
    want = [exchange.rolling(flat[i : i + length], length)[0] for i in range(len(flat) - length + 1)]
    assert got.tolist() == [int(x) for x in want]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=50))
def test_packed_numbers(values):
    for kind in (np.uint32, np.uint64):
        flat = np.array(values, kind)
        assert exchange._unpacked(exchange._packed(flat), kind).tolist() == values


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 12), max_size=12), st.integers(1, 5))
def test_starts_stay_inside_documents(sizes, length):
    ends = np.cumsum(sizes, dtype=np.int64)
    places, first = exchange.starts(ends, length)
    want = [(e - n + k, e - n) for n, e in zip(sizes, ends.tolist()) for k in range(n - length + 1)]
    assert list(zip(places.tolist(), first.tolist())) == want
