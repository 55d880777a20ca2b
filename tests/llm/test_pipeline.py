from collections import Counter, defaultdict
from pathlib import Path

import corpus_pipeline as cp
import pytest
import test_jaccard
import test_lines
import test_packing
from helpers import awkward, awkward_rows, empty

from fettle.llm import queries
from fettle.llm.common import stored

STAGE = dict(cp.STAGES)


def rows_of(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """The documents that go into each stage, and the result."""
    docs, out = queries.documents(spark, sf_dir), []
    for name, stage in cp.STAGES:
        out.append(docs)
        docs = stored(stage(spark, docs, sf_dir), name)
    return [*out, docs]


def test_stages_keep_the_columns(steps):
    assert 4 <= len(cp.STAGES) <= 5 and all(df.columns == cp.COLUMNS for df in steps[:-1])


def test_language_keeps_clean_documents(steps):
    before, after = rows_of(steps[0]), rows_of(steps[1])
    assert set(after) <= set(before) and len(after) > 0.9 * len(before)


def test_lines_equal_brute_force(steps):
    want = Counter((i, t) for i, t, _, _ in test_lines.brute(rows_of(steps[1])).elements())
    assert Counter((i, t) for i, t, _ in rows_of(steps[2])) == want


def test_a_hot_copy_keeps_its_text(spark, sf_dir):
    """A third of a source is one text: one row of it is left, with all its lines."""
    rows = [(i, "\n".join(f"line {k} of one text for all" for k in range(9)), "en", "s", 0) for i in range(20)]
    rows += [(100 + i, f"text {i} has a line\nand another {i * i}", "en", "s", 0) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("line_dedup", "near_duplicates"):
        docs = stored(STAGE[name](spark, docs, sf_dir), name)
    assert [r["text"] for r in docs.where("doc_id < 100").collect()] == [rows[0][1]]
    assert docs.where("text = ''").count() == 0


def test_near_duplicates_equal_brute_force(steps):
    before = [(i, t) for i, t, _ in rows_of(steps[2])]
    want = {i for i, _, c in test_jaccard.brute(before, 5, 80) if i == c}
    assert Counter(i for i, _, _ in rows_of(steps[3])) == Counter(want)


def test_mix_keeps_all_in_shares(steps):
    before, after = rows_of(steps[3]), rows_of(steps[4])
    assert set(before) == set(after) and len(after) < 2 * len(before)
    repeats = defaultdict(set)
    for row, n in Counter(after).items():
        repeats[row[2]].add(n)
    assert all(max(n) - min(n) <= 1 for n in repeats.values())


def test_packing_holds_all(steps):
    texts = defaultdict(list)
    for i, t, _ in rows_of(steps[4]):
        texts[i].append(t)
    assert test_packing.check(steps[5].collect(), texts) > 0.97


def test_sequences_follow_the_mix(spark, sf_dir):
    """By sequence id each source keeps its share, and no sequence has a document twice."""
    text = " ".join(["alpha"] * 600)
    rows = [(i, f"{text} {i}", "en", "big" if i % 10 else "small", 0) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = stored(STAGE["mix_sources"](spark, docs, sf_dir), "mixed")
    packed = STAGE["pack"](spark, mixed, sf_dir).where("start = 0").collect()
    assert "place" not in packed[0].asDict()
    source = {i: s for i, _, _, s, _ in rows}
    packed.sort(key=lambda r: (r["sequence_id"], r["offset"]))
    packed = [r for r in packed if r["sequence_id"] >> 40]  # without the remainders
    small = [i for i, r in enumerate(packed, 1) if source[r["doc_id"]] == "small"]
    share = 150**0.7 / (150**0.7 + 1350**0.7)
    assert len(packed) > 1500 and all(abs(n - at * share) < 3 for n, at in enumerate(small, 1))
    last = {}
    for at in small:
        doc_id = packed[at - 1]["doc_id"]
        assert at - last.get(doc_id, -9999) > 500
        last[doc_id] = at
    assert len(last) < len(small)


def test_steps_leave_no_tables(spark, sf_dir):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir())
    out = STAGE["near_duplicates"](spark, queries.documents(spark, sf_dir), sf_dir)
    assert [p.name.split("-")[0] for p in set(folder.iterdir()) - before] == ["others"]
    assert out.count()


def test_run(spark, sf_dir, steps):
    assert cp.run(spark, sf_dir).count() == steps[5].count()


@pytest.mark.parametrize("name", list(STAGE))
def test_awkward_rows(spark, sf_dir, name):
    for docs in (awkward(spark), empty(spark)):
        out = STAGE[name](spark, docs, sf_dir)
        assert name == "pack" or out.columns == cp.COLUMNS
        assert bool(out.count()) <= bool(docs.count())


def test_repeated_rows_leave_one(spark, sf_dir):
    out = STAGE["near_duplicates"](spark, awkward(spark), sf_dir)
    ids = Counter(r["doc_id"] for r in out.collect() if r["doc_id"] is not None)
    assert ids and max(ids.values()) == 1
    texts = {r[0]: r[1] for r in awkward_rows()}
    assert {0, 1, 2, 3} <= set(ids) and texts[7] and 8 not in ids and 9 not in ids
