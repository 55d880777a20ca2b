import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fettle.llm import negatives
from fettle.llm.negatives import Heaps, first_hits, hard_negatives, strassen, whole_vectors

SCHEMA = "vec_id long, embedding array<double>, label int, `row` string, score string, chunk string"


@pytest.mark.parametrize("n, k, m", [(1, 1, 1), (17, 64, 33), (37, 19, 55), (64, 64, 64), (5, 0, 7), (0, 3, 4), (100, 3, 41)])
@pytest.mark.parametrize("leaf", [1, 2, 16])
def test_strassen_is_exact(n, k, m, leaf):
    rng = np.random.default_rng(n + m)
    a = rng.integers(-(2**62), 2**62, (n, k))
    b = rng.integers(-(2**62), 2**62, (k, m))
    want = (a.astype(object) @ b.astype(object)) if k else np.zeros((n, m), object)
    wrapped = [[(int(v) + 2**63) % 2**64 - 2**63 for v in row] for row in want]
    assert strassen(a, b, leaf).tolist() == wrapped


def test_heaps_merge_in_any_parts():
    rng = np.random.default_rng(3)
    scores = rng.integers(0, 6, (4, 90))
    want = [sorted(range(90), key=lambda j: (-scores[i, j], j))[:5] for i in range(4)]
    for cuts in ([90], [7, 50, 90], [1, 2, 3, 4, 5, 6, 90], [30, 60, 90]):
        heaps, at = Heaps(np.full(4, -1), 5), 0
        for end in cuts:
            part = scores[:, at:end]
            x, y = first_hits(part, part >= heaps.least[:, None], 5)
            heaps.add(x, part[x, y], y + at)
            at = end
        assert [[int(p) for g, p in zip(heaps.group, heaps.place) if g == i] for i in range(4)] == want
        assert heaps.least.tolist() == [int(scores[i, want[i][-1]]) for i in range(4)]


def rows_of(n, dim, seed, labels=4, kinds=None):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        v = [rng.gauss(0, 0.3) for _ in range(dim)] if kinds is None else [rng.randrange(kinds) / 256 for _ in range(dim)]
        out.append((i, v, rng.randrange(labels), "r", "s", "c"))
    return out


def brute(rows, every, positives=5, negatives=5, percent=80):
    """All results by plain loops; repeated rows are rows of their own."""
    kept = []
    for vec_id, v, label, *_ in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((vec_id, [math.floor(256 * x) for x in v], label))
    out = []
    for a, (anchor, v, label) in enumerate(kept):
        if anchor is None or anchor % every:
            continue
        scored = [(-sum(p * q for p, q in zip(v, w)), i is None, i or 0, i, m) for b, (i, w, m) in enumerate(kept) if b != a]
        scored.sort(key=lambda r: r[:3])
        for s, _, _, pos, _ in [r for r in scored if r[4] == label][:positives]:
            below = [r for r in scored if r[4] != label and percent * -s <= 100 * -r[0] <= 100 * -s][:negatives]
            out += [(anchor, pos, k, r[3], -s, -r[0]) for k, r in enumerate(below, 1)]
    return sorted(out, key=str)


def run(spark, rows, every=10, **sizes):
    vectors = whole_vectors(spark.createDataFrame(rows, SCHEMA))
    found = hard_negatives(vectors, F.col("id") % every == 0, **sizes)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()), key=str)


def test_equals_brute_force(spark):
    rows = rows_of(400, 19, 1)
    want = brute(rows, 10)
    assert len(want) > 100 and run(spark, rows) == want


@pytest.mark.parametrize("sizes", [{"stripe_numbers": 300, "block_numbers": 100, "chunk_rows": 7}, {"chunk_rows": 1}])
def test_sizes_of_blocks_do_not_matter(spark, sizes):
    rows = rows_of(120, 6, 2)
    assert run(spark, rows, 5, **sizes) == brute(rows, 5)


def test_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(negatives, "TILE_ANCHORS", 3)
    monkeypatch.setattr(negatives, "TILE_ROWS", 5)
    rows = rows_of(90, 5, 7, kinds=3)
    assert run(spark, rows, 3) == brute(rows, 3)


def test_awkward_rows(spark):
    rows = rows_of(60, 3, 3, labels=3, kinds=3)  # few scores, so many ties
    rows += [
        (None, [0.01, 0.01, 0.01], 1, None, None, None),
        (None, [0.01, 0.01, 0.01], 2, None, None, None),
        (100, None, 1, None, None, None),
        (110, [0.1, None, 0.2], 1, None, None, None),
        (120, [0.1, math.nan, 0.2], 1, None, None, None),
        (130, [0.1, math.inf, 0.2], 1, None, None, None),
        (140, [0.1, 0.1, 0.1], None, None, None, None),
        (150, [], 1, None, None, None),
        (160, [0.02], 2, None, None, None),
        (170, [0.02, 0.0, 0.01, 0.03], 1, None, None, None),
        (180, [-0.02, -0.03, -0.01], 0, None, None, None),
    ]
    rows += [rows[10], rows[10], rows[11]]  # repeated, one of them an anchor
    assert run(spark, rows) == brute(rows, 10)


def test_long_vectors_and_huge_components(spark):
    rows = [(i, [float(i % 7) * 1000.0] * 3000, i % 2, "", "", "") for i in range(30)]
    assert run(spark, rows) == brute(rows, 10)
    assert len(run(spark, rows + [(31, [1e300] * 3000, 1, "", "", "")])) > 0  # cut to 64 bits, no failure


def test_hot_vector(spark):
    """A third of all rows are one vector with one label, some of them labelled otherwise."""
    rows = [(i, [0.5, 0.25, -0.5] if i % 3 == 0 else [random.Random(i).gauss(0, 0.4)] * 3, 1 if i % 21 else 2, "", "", "") for i in range(900)]
    assert run(spark, rows, 50) == brute(rows, 50)


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [0.5], 1, "", "", "")]) == []  # no anchor
    assert run(spark, [(0, [0.5], 1, "", "", "")]) == []  # no other row
