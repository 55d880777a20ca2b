"""Alignment of the tokens of two tokenizers over the same bytes.

Both sides cut the same bytes. ``merge_asof``, keyed by document, finds for the start of each
token the token of the other side that covers it; the union of both directions is all pairs
that overlap. Where the two tokens of a pair end together, both sides have a border: these
borders cut the tokens into groups, and the pair is a link.

How often a pair of ids is linked in the whole corpus is counted over batches of some MB of
text: a batch sends each of its distinct pairs once, and gets their counts back.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fettle.llm.common import stored, worker_cache

# Bytes of text aligned at a time, and of a batch, whose pairs are counted together. A longer
# text is taken alone.
ALIGN_BYTES = 500_000
BATCH_BYTES = 8_000_000

BATCHES = (
    "batch long, docs array<struct<doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, "
    "n_overlaps: long, groups_sha256: string>>, pairs array<long>, counts array<long>, links binary"
)
ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string, n_overlaps long"
)


def _byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable bytes are their own letters; the others, in order, have the letters from 256 on.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Side:
    """Ids of a text and the bytes of each id."""

    def __init__(self, bytes_of: list[bytes]):
        self.bytes_of = bytes_of
        self.sizes = np.array([len(b) for b in bytes_of], np.int64)
        # The id in decimals with what may follow it in a list of groups.
        shown = {mark: [b"%d%s" % (i, mark) for i in range(len(bytes_of))] for mark in (b",", b"|", b";", b"")}
        self.shown = {mark: np.array(ids, object) for mark, ids in shown.items()}

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class ByteSide(Side):
    """Byte-level merges; the vocabulary's ids are the ranks of its merges."""

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN

        with open(path, encoding="utf-8") as file:
            read = json.load(file)
        of, special = _byte_of_letter(), {t["content"] for t in read["added_tokens"]}
        ranks = {bytes(of[c] for c in t): i for t, i in read["model"]["vocab"].items() if t not in special}
        bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            bytes_of[i] = token
        super().__init__(bytes_of)
        self.encoding = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(t) for t in texts]


class PieceSide(Side):
    """Pieces with byte fallback; the space before a text is the tokenizer's own."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        super().__init__(
            [
                bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in enumerate(pieces)
            ]
        )

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def covering(tokens: pd.DataFrame, others: pd.DataFrame) -> np.ndarray:
    """For the start of each token the place of the other side's token that covers it."""
    found = pd.merge_asof(tokens[["start", "doc"]], others[["start", "doc", "place"]], on="start", by="doc")
    return found["place"].to_numpy()


def _tokens(side: Side, ids: list[list[int]]) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """Tokens of texts in a row (doc, start, place), with their ids and ends."""
    counts = np.array([len(i) for i in ids], np.int64)
    flat = np.fromiter(chain.from_iterable(ids), np.int64, int(counts.sum()))
    ends = np.cumsum(side.sizes[flat])
    frame = pd.DataFrame(
        {"doc": np.repeat(np.arange(len(ids), dtype=np.int32), counts), "start": ends - side.sizes[flat], "place": np.arange(len(flat))}
    )
    return frame, flat, ends


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs whose bytes overlap, each pair once."""
    of_a, of_b = covering(a, b), covering(b, a)
    # A pair that starts together is found in both directions.
    once = a["start"].to_numpy()[of_b] != b["start"].to_numpy()
    places = b["place"].to_numpy()
    return np.concatenate([a["place"].to_numpy(), of_b[once]]), np.concatenate([of_a, places[once]])


def _groups(sides: tuple[Side, Side], ids: tuple, last: tuple, docs: np.ndarray, n_docs: int) -> list[bytes]:
    """The groups of each document as text; ``last`` has the places where groups end.

    Tokens of both sides take their places in the text by counting those that come before.
    """
    group = [np.searchsorted(end, np.arange(len(i))) for end, i in zip(last, ids, strict=True)]
    before = [np.concatenate([[0], end + 1]) for end in last]
    place_a = np.arange(len(ids[0])) + before[1][group[0]]
    place_b = np.arange(len(ids[1])) + before[0][group[1] + 1]
    shown = np.empty(len(ids[0]) + len(ids[1]), object)
    doc_of = docs[last[0]]
    ends_doc = np.ones(len(doc_of), bool)
    ends_doc[:-1] = doc_of[1:] != doc_of[:-1]
    for side, i, place, end, mark in zip(sides, ids, (place_a, place_b), last, (b"|", b";"), strict=True):
        shown[place] = side.shown[b","][i]
        shown[place[end]] = side.shown[mark][i[end]]
    closing = last[1][ends_doc]
    shown[place_b[closing]] = sides[1].shown[b""][ids[1][closing]]
    cuts = (place_b[closing] + 1).tolist()
    out, at = [b""] * n_docs, 0
    for doc, cut in zip(doc_of[ends_doc].tolist(), cuts, strict=True):
        out[doc], at = b"".join(shown[at:cut]), cut
    return out


def align(sides: tuple[Side, Side], texts: list[str | None]) -> tuple[list[dict], np.ndarray]:
    """Per text its counts, groups and overlaps, and the linked id pairs of all in a row.

    A pair is one number: the first side's id times 2^32 plus the other's.
    """
    whole = [(" " + t) if t else "" for t in texts]
    ids_a = sides[0].encode(whole)
    ids_b = sides[1].encode([t or "" for t in texts])
    for k, text in enumerate(whole):
        raw = text.encode()
        if not raw or sides[0].joined(ids_a[k]) != raw or sides[1].joined(ids_b[k]) != raw:
            ids_a[k], ids_b[k] = [], []
    a, flat_a, ends_a = _tokens(sides[0], ids_a)
    b, flat_b, ends_b = _tokens(sides[1], ids_b)
    n = len(texts)
    facts = [{"n_a": len(x), "n_b": len(y), "n_groups": 0, "n_links": 0, "n_overlaps": 0, "groups": b""} for x, y in zip(ids_a, ids_b, strict=True)]
    if not len(flat_a):
        return facts, np.empty(0, np.int64)
    left, right = overlaps(a, b)
    together = ends_a[left] == ends_b[right]
    end_a, end_b = np.sort(left[together]), np.sort(right[together])
    doc = a["doc"].to_numpy()
    linked, overlapping = np.bincount(doc[end_a], minlength=n), np.bincount(doc[left], minlength=n)
    texts_of_groups = _groups(sides, (flat_a, flat_b), (end_a, end_b), doc, n)
    for k, fact in enumerate(facts):
        # No token is empty, so each common border ends one group and is one link.
        fact["n_groups"] = fact["n_links"] = int(linked[k])
        fact["n_overlaps"], fact["groups"] = int(overlapping[k]), texts_of_groups[k]
    return facts, (flat_a[end_a] << 32) | flat_b[end_b]


def _sides(path_a: str, path_b: str) -> tuple[Side, Side]:
    return worker_cache(f"sides {path_a} {path_b}", lambda: (ByteSide(path_a), PieceSide(path_b)))


def _shared(docs: DataFrame, path_a: str, path_b: str, align_bytes: int, batch_bytes: int) -> DataFrame:
    """Batches of aligned documents, each with its distinct linked pairs and their counts."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        texts: list[str | None] = []
        found: list[dict] = []
        links: list[np.ndarray] = []
        held = waiting = 0

        def aligned() -> None:
            nonlocal ids, texts, waiting
            if not ids:
                return
            facts, pairs = align(sides, texts)
            links.append(pairs)
            for doc_id, fact in zip(ids, facts, strict=True):
                groups = fact.pop("groups")
                shown = hashlib.sha256(groups).hexdigest() if fact["n_a"] else ""
                found.append({"doc_id": doc_id, **fact, "groups_sha256": shown})
            ids, texts, waiting = [], [], 0

        def batch() -> pa.RecordBatch:
            nonlocal found, links, held, number
            pairs, of, counts = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
            packed = zstandard.ZstdCompressor(level=1).compress(of.astype(np.uint32).reshape(-1, 1).view(np.uint8).T.tobytes())
            row = [{"batch": number, "docs": found, "pairs": pairs, "counts": counts, "links": packed}]
            found, links, held, number = [], [], 0, number + 1
            return pa.RecordBatch.from_pylist(row, schema)

        for part in rows:
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                size = len(text or "")
                if waiting + size > align_bytes:
                    aligned()
                if held and held + size > batch_bytes:
                    aligned()
                    yield batch()
                ids.append(doc_id)
                texts.append(text)
                waiting, held = waiting + size, held + size
        aligned()
        if found:
            yield batch()

    doc = pa.struct([(n, pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps")] + [("groups_sha256", pa.string())])
    numbers = pa.list_(pa.int64())
    schema = pa.schema([("batch", pa.int64()), ("docs", pa.list_(doc)), ("pairs", numbers), ("counts", numbers), ("links", pa.binary())])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, BATCHES)


def align_tokens(
    docs: DataFrame, path_a: str, path_b: str, align_bytes: int = ALIGN_BYTES, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """How the tokens of two tokenizers lie over each text, and how usual their links are.

    ``path_a`` is a byte-level vocabulary that reads a space and the text, ``path_b`` a piece
    model that adds the space itself. Returns for each row doc_id, the numbers of tokens
    (n_a, n_b), groups, links and overlapping pairs, n_best (links whose pair is linked most
    often in the corpus of all pairs of its second id, ties included), count_sum (the corpus
    counts of all its links) and the digest of the groups' text, ids of a group in order.

    A text that is null or empty, or that one of the tokenizers does not give back byte by
    byte, has no tokens: zeros and an empty digest. Repeated rows and rows without an id are
    rows of their own; other columns are not read. An empty table gives an empty result.
    """
    batches = stored(_shared(docs, path_a, path_b, align_bytes, batch_bytes), "aligned")
    told = batches.select("batch", F.inline(F.arrays_zip("pairs", "counts")))
    totals = told.groupBy("pairs").agg(F.sum("counts").alias("total"))
    totals = stored(totals.select(F.col("pairs").alias("pair"), "total", F.col("pairs").bitwiseAND(0xFFFFFFFF).alias("b")), "totals")
    # A row for each id of the second vocabulary at most.
    best = totals.groupBy("b").agg(F.max("total").alias("most"))
    judged = totals.join(F.broadcast(best), "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))

    asked = told.select("batch", F.col("pairs").alias("pair"))
    answers = asked.join(judged, "pair").groupBy("batch").agg(
        F.sort_array(F.collect_list(F.struct("pair", "total", "best"))).alias("answers")
    )
    answers = answers.select(F.col("batch").alias("_batch"), "answers.total", "answers.best")
    whole = batches.select("batch", "docs", "links").join(answers, F.col("batch") == F.col("_batch"), "left")

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            for at in range(part.num_rows):
                row = part.slice(at, 1)
                docs = row.column("docs").flatten()
                total, best = (np.append(row.column(c).flatten().to_numpy(zero_copy_only=False), 0) for c in ("total", "best"))
                planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(row.column("links")[0].as_py()), np.uint8)
                of = np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).reshape(-1)
                column = {f.name: docs.field(i) for i, f in enumerate(docs.type)}
                ends = np.concatenate([[0], np.cumsum(column["n_links"].to_numpy())])
                sums = [np.concatenate([[0], np.cumsum(v[of].astype(np.int64))])[ends] for v in (best, total)]
                n_best, count_sum = (pa.array(np.diff(s), pa.int64()) for s in sums)
                column |= {"n_best": n_best, "count_sum": count_sum}
                yield pa.RecordBatch.from_pydict({c.split()[0]: column[c.split()[0]] for c in ALIGNED.split(", ")})

    return whole.select("docs", "links", "total", "best").mapInArrow(read, ALIGNED)
