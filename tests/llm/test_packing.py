import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import awkward, awkward_rows, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fettle.llm import packing, queries

PATH = queries.tokenizer_path()
TOKENIZER = Tokenizer.from_file(PATH)


def whole_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, texts):
    """All ids once, in order, in gapless sequences of 2048 at most."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for doc_id, same in texts.items():
        assert sum(r["length"] for r in by_doc.pop(doc_id)) == sum(len(whole_ids(t)) for t in same)
        for t in same:
            ids = whole_ids(t)
            mine = [r for r in rows if r["doc_id"] == doc_id and r["doc_tokens"] == len(ids)]
            for start, length in {(r["start"], r["length"]) for r in mine}:
                part = np.array(ids[start : start + length], "<u4").tobytes()
                assert zlib.crc32(part) in {r["ids_crc32"] for r in mine if (r["start"], r["length"]) == (start, length)}
    assert not by_doc
    filled = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= 2048
        filled += at
    return filled / (2048 * len(by_sequence))


def test_documents(spark, sf_dir):
    docs = queries.documents(spark, sf_dir)
    rows = queries.op1_harmonic_packing(spark, sf_dir).collect()
    texts = {r["doc_id"]: [r["text"]] for r in docs.collect()}
    assert check(rows, texts) > 0.97


def test_awkward_rows(spark):
    rows = queries.packed_pieces(awkward(spark)).collect()
    texts = defaultdict(list)
    for r in awkward_rows():
        texts[r[0]].append(r[1])
    check(rows, texts)


def test_empty(spark):
    out = queries.packed_pieces(empty(spark))
    assert out.count() == 0 and {"sequence_id", "offset"} <= set(out.columns)


def test_full_bins_have_a_fixed_count(spark):
    """With many equal lengths, all bins of a class but the left over one hold k pieces."""
    pieces = spark.range(10_000).selectExpr("id as doc_id", "0L as start", "682L as length")
    rows = packing.harmonic_pack(pieces).collect()
    per_bin = Counter(r["sequence_id"] for r in rows)
    assert Counter(per_bin.values()) == {3: 3333, 1: 1}


def test_other_columns_stay(spark):
    pieces = spark.range(50).selectExpr("id as doc_id", "0L as start", "id * 30 + 1 as length", "id as _rank", "'z' as `_class`", "'q' as offset")
    out = packing.harmonic_pack(pieces)
    assert out.columns == ["doc_id", "start", "length", "_rank", "_class", "sequence_id", "offset"]
    assert {(r["doc_id"], r["_rank"], r["_class"]) for r in out.collect()} == {(i, i, "z") for i in range(50)}


@pytest.mark.parametrize("capacity", [64, 2048])
def test_cuts(capacity):
    for total in range(1, 3 * capacity):
        pieces = packing.cuts(total, capacity)
        assert sum(pieces) == total and all(0 < p <= capacity for p in pieces) and len(pieces) < 9


def test_best_fit_keeps_all():
    lengths = [1024, 5, 1024, 700, 700, 648, 2048]
    placed = packing.best_fit(lengths, 2048)
    assert sorted(i for i, _, _ in placed) == list(range(7)) and max(b for _, b, _ in placed) == 3


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abZ0'.,!?séçÅ ßİΣσ\u1100\u1161\u212b\n\t \x1c\x85́<|>endoftx#5　日")), max_size=60))
def test_word_ids_equal_the_tokenizer(text):
    known = packing._word_ids(PATH)
    assert np.frombuffer(known.texts([text, "<|endoftext|>" + text])[0], "<u4").tolist() == whole_ids(text)[:-1]


def test_words_of_one_text_are_held_at_a_time(monkeypatch):
    """The words of all texts were held, and a set of them made, before any was looked up."""
    texts = [" ".join(f"word{(i * 7 + j) % 5000}" for j in range(400)) for i in range(500)]
    known = packing.WordIds(PATH)
    ids = known.texts(texts)
    tracemalloc.start()
    again = known.texts(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert again == ids and peak < 2 * sum(map(len, ids))
    # A worker that starts afresh in the middle of a text gives the same ids.
    monkeypatch.setattr(packing, "CACHED_WORDS", 100)
    assert packing.WordIds(PATH).texts(texts[:20]) == ids[:20]
