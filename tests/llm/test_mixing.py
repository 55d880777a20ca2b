from collections import Counter
from fractions import Fraction

import pytest
from helpers import awkward, empty

from fettle.llm import mixing


def test_frame_meets_all_windows():
    shares = {"a": 1, "b": 7, "c": 8, "d": 13, "e": 71}
    plan = mixing.frame_schedule(shares)
    assert [slot for _, _, slot, _, _ in plan] == list(range(100))
    assert all(release <= slot < due for _, _, slot, release, due in plan)
    done = Counter()
    for name, block, slot, _, _ in plan:
        assert done[name] == block
        done[name] += 1
        assert all(abs(done[k] - Fraction(shares[k] * (slot + 1), 100)) < 1 for k in shares)


def test_frames_hold_the_real_weights():
    """Less than one block from the target over many frames, though 20 does not divide 4096."""
    sizes = {f"s{i}": 1000 for i in range(18)} | {"odd": 317, "small": 3}
    total = sum(n**0.7 for n in sizes.values())
    shares = mixing.whole_shares({k: n**0.7 for k, n in sizes.items()}, mixing.UNITS)
    done = Counter()
    for frame in range(0, 60):
        assert mixing.started(shares, frame * 4096) == {k: done[k] for k in shares}
        for name, block, slot, release, due in mixing.frame_schedule(shares, frame * 4096, (frame + 1) * 4096):
            assert release <= slot < due and done[name] == block
            done[name] += 1
        assert all(abs(done[k] - (slot + 1) * n**0.7 / total) < 1 for k, n in sizes.items())
    last = 2_500_000 * 4096  # ten thousand million slots on
    far = mixing.started(shares, last)
    assert sum(far.values()) == last and all(abs(far[k] - last * n**0.7 / total) < 1.01 for k, n in sizes.items())


def test_rows_hold_the_real_weights(spark):
    """Over eight frames of 64 slots, sources worth 1.3 to 34 slots of a frame."""
    rows = [(i, f"s{min(i % 40, 7)}") for i in range(400)] + [(400 + i, "tiny") for i in range(2)]
    sizes = Counter(s for _, s in rows)
    total = sum(n**0.7 for n in sizes.values())
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), frame=64).collect()
    assert len(out) > 8 * 64
    check(out, 402, {k: n**0.7 / total for k, n in sizes.items()})


def test_shares_add_up():
    shares = mixing.whole_shares({"a": 0.5, "b": 0.3, "c": 0.2, "d": 1e-9}, 64)
    assert sum(shares.values()) == 64 and min(shares.values()) == 1


def check(rows, n_docs, weights):
    """Gapless slots, each document at least once, less than one block from the target."""
    rows = sorted(rows, key=lambda r: r["slot"])
    assert [r["slot"] for r in rows] == list(range(len(rows)))
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in rows)
    assert len({r["doc_id"] for r in rows}) == n_docs
    done = Counter()
    for t, r in enumerate(rows, 1):
        done[r["source"]] += 1
        assert all(abs(done[s] - t * w) < 1 for s, w in weights.items())
    seen = Counter((r["doc_id"], r["epoch"]) for r in rows)
    assert max(seen.values()) == 1


def test_given_weights(spark):
    rows = [(i, "big" if i % 4 else "small") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    out = mixing.mix(docs, {"big": 0.5, "small": 0.5}, frame=64).collect()
    check(out, 400, {"big": Fraction(1, 2), "small": Fraction(1, 2)})
    assert max(r["epoch"] for r in out if r["source"] == "small") == 2 and len(out) == 599
    assert max(r["epoch"] for r in out if r["source"] == "big") == 0


def test_hot_source_by_temperature(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(2100)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    sizes = Counter(s for _, s in rows)
    total = sum(n**0.7 for n in sizes.values())
    out = mixing.mix(docs, frame=128).collect()
    check(out, 2100, {k: Fraction(n**0.7 / total) for k, n in sizes.items()})
    assert len(out) < 2 * 2100


def test_small_weights_are_held(spark):
    """A weight far below a slot of a frame: 3 documents of 2,003 slots each, over many frames."""
    rows = [(i, "small" if i < 3 else "big") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    weights = {"big": 2002 / 2003, "small": 1 / 2003}
    out = mixing.mix(docs, weights, frame=64).collect()
    check(out, 1000, {k: Fraction(w) for k, w in weights.items()})
    assert 2 * 2003 < len(out) <= 3 * 2003 and sum(r["source"] == "small" for r in out) == 3
    with pytest.raises(ValueError, match="small"):
        mixing.mix(docs, {"big": 1.0, "small": 1e-7})


def test_unlisted_sources_are_pooled(spark):
    rows = [(i, ["a", "b", "c", None][i % 4]) for i in range(400)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), {"a": 0.25, "zz": 0.5}).collect()
    assert {r["doc_id"] for r in out} == set(range(400))
    assert sorted(r["slot"] for r in out) == list(range(len(out)))


def test_long_tail_keeps_its_weight(spark):
    """2,000 sources of 1 to 3 documents beside one of 3,000: the tail holds sum of n ** 0.7."""
    rows = [(i, "big") for i in range(3000)]
    rows += [(10_000 + 10 * i + j, f"t{i}") for i in range(2000) for j in range(1 + i % 3)]
    sizes = Counter(s for _, s in rows)
    total = sum(n**0.7 for n in sizes.values())
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    out = sorted(mixing.mix(docs, frame=256).collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in out] == list(range(len(out))) and {r["doc_id"] for r in out} == {i for i, _ in rows}
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in out)
    big = 0
    for t, r in enumerate(out, 1):
        big += r["source"] == "big"
        assert abs(big - t * 3000**0.7 / total) < 1
    # Inside the pool too: each source, and each size of source, in every part of the mix.
    for end in (len(out) // 3, len(out) // 2, len(out)):
        done = Counter(r["source"] for r in out[:end])
        assert all(abs(done[s] - end * n**0.7 / total) < 2 for s, n in sizes.items() if s != "big")
        for n in (1, 2, 3):
            alike = [s for s in sizes if sizes[s] == n]
            want = end * n**0.7 / total * len(alike)
            assert abs(sum(done[s] for s in alike) - want) < 0.05 * want
    assert max(Counter((r["doc_id"], r["epoch"]) for r in out).values()) == 1


def test_awkward_rows(spark):
    docs = awkward(spark)
    out = mixing.mix(docs)
    assert out.columns == [*docs.columns, "slot", "epoch", "release", "deadline"]
    got = Counter(tuple(r)[: len(docs.columns)] for r in out.where("epoch = 0").collect())
    assert got == Counter(tuple(r) for r in docs.collect())


def test_own_columns_are_replaced(spark):
    docs = spark.createDataFrame([(1, "a", "x", "y")], "doc_id long, source string, slot string, `_row` string")
    out = mixing.mix(docs)
    assert out.columns == ["doc_id", "source", "_row", *mixing.PLACES] and tuple(out.first())[:4] == (1, "a", "y", 0)


def test_empty(spark):
    assert mixing.mix(empty(spark)).count() == 0
