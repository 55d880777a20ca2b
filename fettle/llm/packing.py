"""Harmonic packing of tokenized documents into sequences of fixed capacity.

Lengths fall into reciprocal classes: class k holds the lengths in (C/(k+1), C/k], and a
bin of class k always takes k pieces. Which bin a piece goes to follows from its rank in
its class alone, so all workers fill bins at the same time without looking at each other.

Documents may be cut. A remainder that would leave a bin of its class too empty gives off
a piece of exactly C // (k+1) ids, which fills a bin of class k+1, and goes on with the
rest; three or four pieces are usual.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from string import punctuation
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fettle.llm.common import stored, with_rank, worker_cache

CAPACITY = 2048
END_ID = 1
# Ids a bin of a class may leave unused before a remainder is cut rather than packed whole.
SLACK = 32
# Words whose ids a worker keeps; beyond it the worker starts afresh.
CACHED_WORDS = 1_000_000
# Documents that follow each other whose pieces of one class are ranked together.
PLACE_BLOCK = 4096

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def cuts(total: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[int]:
    """Lengths of the pieces of a document with ``total`` ids, in order."""
    pieces = [capacity] * (total // capacity)
    rest = total % capacity
    while rest:
        k = capacity // rest
        size = rest if rest <= slack or capacity - k * rest <= slack else capacity // (k + 1)
        pieces.append(size)
        rest -= size
    return pieces


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves; the others, in order, for the letters from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordIds(dict):
    """Ids of white-space separated words as little-endian 32-bit bytes.

    The tokenizer drops white space and never joins across it, so the ids of a text are
    those of its words in a row. A run of letters goes straight to the vocabulary's merges,
    and marks after it are known by then; all other words are tokenized as texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.bytes_of = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.letters_of = _byte_letters()
        self.marks = {"": b""}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def run(self, letters: str) -> bytes:
        """Ids of lower-case letters alone."""
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(self.letters_of)
        return b"".join([self.bytes_of[t.id] for t in self.tokenizer.model.tokenize(letters)])

    def __missing__(self, word: str) -> bytes:
        if len(self) > CACHED_WORDS:
            self.clear()
        low = word.lower()
        stem = low.rstrip(punctuation)
        # Python's lower case differs from the tokenizer's, letter by letter, in a final sigma.
        plain = stem.isascii() or is_normalized("NFC", word) and is_normalized("NFC", low) and "\u03a3" not in word
        if not (plain and stem.isalpha()):
            ids = self[word] = self.whole(word)
            return ids
        ids = self.get(stem)
        if ids is None:
            ids = self[stem] = self.run(stem)
        mark = low[len(stem) :]
        if mark not in self.marks:
            if len(self.marks) > CACHED_WORDS:
                self.marks = {"": b""}
            self.marks[mark] = self.whole(mark)
        ids = self[word] = ids + self.marks[mark]
        return ids

    def texts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        # Special tokens match across word ends; four control marks split Python's words only.
        odd = ["<|" in t or any(c in t for c in "\x1c\x1d\x1e\x1f") for t in texts]
        get = self.__getitem__
        return [
            self.whole(t) if o else b"".join(map(get, t.split()))
            for t, o in zip(texts, odd, strict=True)
        ]


def _word_ids(path: str) -> WordIds:
    """Later tasks of a worker find the words of earlier ones."""
    return worker_cache(f"words {path}", lambda: WordIds(path))


def cut_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    slack: int = SLACK,
    end_id: int = END_ID,
    place: str | None = None,
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, doc_tokens, ids, and the long ``place``.

    ``ids`` are the piece's token ids as little-endian 32-bit words; ``end_id`` closes each
    document. A null or empty text is a document of the closing id alone. Repeated rows are
    documents of their own. Columns other than doc_id, text and ``place`` are not read.
    """

    own = [place] if place else []
    names = ["doc_id", "start", "length", "doc_tokens", "ids", *own]
    kinds = [pa.int64()] * 4 + [pa.binary()] + [pa.int64()] * len(own)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, close = _word_ids(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [t or "" for t in part.column(1).to_pylist()]
                out: list[list] = [[] for _ in names]
                places = [(p,) for p in part.column(2).to_pylist()] if place else [()] * len(texts)
                for doc_id, raw, at_place in zip(part.column(0).to_pylist(), known.texts(texts), places, strict=True):
                    raw += close
                    total, start = len(raw) // 4, 0
                    for size in cuts(total, capacity, slack):
                        row = (doc_id, start, size, total, raw[4 * start : 4 * (start + size)], *at_place)
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                        start += size
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    schema = PIECES + "".join(f", `{c}` long" for c in own)
    return docs.select(F.col("doc_id").cast("long"), "text", *own).mapInArrow(pieces, schema)


def best_fit(lengths: list[int], capacity: int) -> list[tuple[int, int, int]]:
    """(index, bin, offset) of each length, longest first into the fullest bin with room."""
    room: list[tuple[int, int]] = []  # (free, bin), by free
    placed, bins = [], 0
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = bisect.bisect_left(room, (lengths[i], -1))
        if at < len(room):
            free, number = room.pop(at)
        else:
            free, number = capacity, bins
            bins += 1
        placed.append((i, number, capacity - free))
        if free > lengths[i]:
            bisect.insort(room, (free - lengths[i], number))
    return placed


def harmonic_pack(pieces: DataFrame, capacity: int = CAPACITY, place: str | None = None) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, start, length and any other columns),
    in place of any of that name.

    A full bin of class k has k pieces; offsets have no gaps. What is left over of each
    class, less than one bin of it, is at most ``capacity`` bins together whatever the size
    of the input; one task packs it by best fit. An empty table gives an empty result.
    Equal rows are interchangeable and each gets its own place.

    ``place`` names a column with the place of a document among all, from 0 and without large
    gaps. The pieces of a class then fill its bins in that order, so sequences by id, inside
    a class, follow it. Without it they come in an order by hash.
    """
    klass = F.floor(F.lit(capacity) / F.col("length")).cast("long")
    order = ["doc_id", "start", "length"]
    extra, blocks = [], None
    if place:
        extra, order = [F.col(place).alias("_place")], ["_place", "start", "doc_id", "length"]
        blocks = F.expr(f"_place div {PLACE_BLOCK}")
    pieces = pieces.drop("sequence_id", "offset")
    # Columns travel as one, so that none is taken for a column of the steps below.
    whole = F.struct(*[F.col(f"`{c}`") for c in pieces.columns]).alias("_row")
    rows = stored(pieces.select(whole, "doc_id", "start", "length", *extra), "pieces").withColumn("_class", klass)
    totals = rows.groupBy("_class").agg(F.count(F.lit(1)).alias("_total"))
    totals = totals.select(F.col("_class").alias("_k"), "_total")  # a row for each class, capacity at most
    ranked = with_rank(rows, "_class", order, "_rank", blocks).join(F.broadcast(totals), F.col("_class") == F.col("_k"))
    ranked = ranked.withColumn("_bin", F.floor(F.col("_rank") / F.col("_class")).cast("long"))
    ranked = stored(ranked.withColumn("_full", (F.col("_bin") + 1) * F.col("_class") <= F.col("_total")), "ranked")

    in_bin = Window.partitionBy("sequence_id").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    full = (
        ranked.where("_full")
        .withColumn("sequence_id", F.shiftleft(F.col("_class"), 40) + F.col("_bin"))
        .withColumn("offset", F.coalesce(F.sum("length").over(in_bin), F.lit(0)))
    )
    kept = ["_row.*", "sequence_id", "offset"]
    rest = ranked.where("not _full").select("_row", *order)

    def place(left: pa.Table) -> pa.Table:
        left = left.sort_by([(c, "ascending") for c in order])
        where = sorted(best_fit(left["length"].to_pylist(), capacity))
        left = left.append_column("sequence_id", pa.array([b for _, b, _ in where], pa.int64()))
        return left.append_column("offset", pa.array([o for _, _, o in where], pa.int64()))

    schema = T.StructType([*rest.schema.fields]).add("sequence_id", "long").add("offset", "long")
    packed = rest.groupBy().applyInArrow(place, schema)
    return full.select(*kept).unionByName(packed.select(*kept))
