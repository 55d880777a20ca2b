import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from helpers import SCHEMA, awkward, awkward_rows, empty, words
from tokenizers import Tokenizer

from fettle.llm.alignment import ByteSide, PieceSide, align, align_tokens

PATH_A, PATH_B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [
    "don't we'll  two   three    four\n\n\n five\t\tsix ",
    " leading and trailing ",
    "<|endoftext|> and </s> and <s> and <unk> and <0x41>",
    "▁ is a mark of its own",
    "naïve façade — “quoted” … 12345 67 ½ №5",
    "日本語のテキスト 한국어 Ελληνικά русский العربية",
    "👩‍👩‍👧 ​ 　 é ﻿",
    "\x00\x01 \r\n\x1c\x85 ",
    "a" * 5000,
    " " * 300,
    "x",
    "É",
]


@pytest.fixture(scope="module")
def sides():
    return ByteSide(PATH_A), PieceSide(PATH_B)


class Plain:
    """The same rules, token by token, with the tokenizers used as their libraries say."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(PATH_A), sentencepiece.SentencePieceProcessor(model_file=PATH_B)
        self.a.encode_special_tokens = True
        chars = [c for c in map(chr, [*range(1 << 16), *range(1 << 16, 0x110000, 1 << 14)]) if not "\ud800" <= c <= "\udfff"]
        shown = {self.a.pre_tokenizer.pre_tokenize_str(c)[0][0]: c for c in chars if len(c.encode()) == 1}
        # Two-byte letters show their bytes in order: what is left comes from them.
        for c in chars:
            for letter, byte in zip(self.a.pre_tokenizer.pre_tokenize_str(c)[0][0], c.encode(), strict=True):
                shown.setdefault(letter, byte)
        self.byte = {k: v if isinstance(v, int) else ord(v) for k, v in shown.items()}

    def tokens(self, text):
        """(ids, ends) of both sides, or None."""
        if not text:
            return None
        raw = (" " + text).encode()
        ids = [self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)]
        spans = [[bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in ids[0]]]
        pieces = [self.b.id_to_piece(i) for i in ids[1]]
        spans.append([bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids[1], pieces)])
        if any(b"".join(s) != raw for s in spans):
            return None
        return [(i, [sum(map(len, s[: k + 1])) for k in range(len(s))]) for i, s in zip(ids, spans)]

    def rows(self, docs):
        found, counts = [], Counter()
        for doc_id, text in docs:
            tokens = self.tokens(text)
            if tokens is None:
                found.append((doc_id, 0, 0, [], [], 0))
                continue
            (a, ends_a), (b, ends_b) = tokens
            links = [(x, y) for x, i in zip(a, ends_a) if i in set(ends_b) for y, j in zip(b, ends_b) if i == j]
            counts.update(links)
            groups, at = [], [0, 0]
            for i, end in enumerate(ends_a):
                if end in ends_b:
                    j = ends_b.index(end)
                    groups.append((a[at[0] : i + 1], b[at[1] : j + 1]))
                    at = [i + 1, j + 1]
            begins = [[0, *ends_a], [0, *ends_b]]
            over = sum(max(begins[0][i], begins[1][j]) < min(ends_a[i], ends_b[j]) for i in range(len(a)) for j in range(len(b)))
            found.append((doc_id, len(a), len(b), groups, links, over))
        best = defaultdict(int)
        for (_, y), n in counts.items():
            best[y] = max(best[y], n)
        out = []
        for doc_id, n_a, n_b, groups, links, over in found:
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            digest = hashlib.sha256(text.encode()).hexdigest() if n_a else ""
            n_best = sum(counts[p] == best[p[1]] for p in links)
            out.append((doc_id, n_a, n_b, len(groups), len(links), n_best, sum(counts[p] for p in links), digest, over))
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


def check(df, docs, plain):
    assert sorted(map(tuple, df.collect()), key=str) == sorted(plain.rows(docs), key=str)


def test_ids_are_those_of_the_vocabulary_file(sides, plain, spark, sf_dir):
    texts = [" " + r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect() if r.text]
    texts += [" " + t for t in ODD]
    want = [plain.a.encode(t, add_special_tokens=False).ids for t in texts]
    assert sides[0].encode(texts) == want
    # Bytes that no UTF-8 text has are single tokens.
    table = {i: plain.a.id_to_token(i) for i in range(50256)}
    shown = {i: t for i, t in table.items() if all(c in plain.byte for c in t)}
    assert len(shown) == 50256 - 13
    assert all(bytes(plain.byte[c] for c in t) == sides[0].bytes_of[i] for i, t in shown.items())


def test_odd_texts(spark, plain):
    docs = [(i, t) for i, t in enumerate([*ODD[:8], "x", "É", "", None, *ODD[:3]])]
    check(align_tokens(spark.createDataFrame(docs, "doc_id long, text string"), PATH_A, PATH_B), docs, plain)


@pytest.mark.parametrize("sizes", [(1, 1), (300, 700), (5_000, 100_000)])
def test_sizes_of_batches_do_not_matter(spark, sf_dir, plain, sizes):
    found = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = [(r.doc_id, r.text[:600]) for r in found.limit(40).collect()]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    check(align_tokens(rows, PATH_A, PATH_B, *sizes), docs, plain)


def test_awkward_rows(spark, sides, plain):
    """Very long texts against the aligned sides, all others against the plain rules."""
    got = {(r.doc_id, r.n_a): r for r in align_tokens(awkward(spark), PATH_A, PATH_B).collect()}
    texts = [(r[0], r[1]) for r in awkward_rows()]
    facts, _ = align(sides, [t for _, t in texts])
    assert {(i, f["n_a"]) for (i, _), f in zip(texts, facts)} == set(got)
    short = [(i, t) for i, t in texts if len(t or "") < 2000]
    for (doc_id, n_a, n_b, n_groups, n_links, _, _, digest, over) in plain.rows(short):
        r = got[doc_id, n_a]
        assert (r.n_b, r.n_groups, r.n_links, r.groups_sha256, r.n_overlaps) == (n_b, n_groups, n_links, digest, over)
    assert SCHEMA


def test_hot_text(spark, plain):
    docs = [(i, "the same text again" if i % 3 == 0 else words(i, 12)) for i in range(300)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    check(align_tokens(rows, PATH_A, PATH_B, 50, 200), docs, plain)


def test_empty(spark):
    assert align_tokens(empty(spark), PATH_A, PATH_B).count() == 0
