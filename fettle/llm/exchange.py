"""Counting hashes over all documents without a row for each hash.

Documents are put together to batches of a few MB, one table row each. A batch asks about
its distinct hashes: they are dealt by their first bits over buckets, and each bucket of a
batch is one row of packed numbers. A bucket sees what all batches say about a hash, and
answers each batch with one small number for each hash asked, in the order asked. A batch
works out its hashes again when it reads the answers, so no positions travel.

The shuffle moves two to three bytes a distinct hash of a batch (or eight for exact ones),
and a hash that is everywhere comes once from each batch, so no bucket is hot.

Every batch has a row for every bucket. With sizes of their own, batches and buckets both grow
with the root of the text, so that the rows stay in proportion to it (``sizes_for``).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fettle.llm.common import stored, worker_cache

# Bytes of text in a batch (a longer text is a batch alone) and, on average, in a bucket: so
# many at least, and so many that a row of the exchange stands for ROW_BYTES.
BATCH_BYTES = 4_000_000
BUCKET_BYTES = 8_000_000
ROW_BYTES = 1_000
# Words whose hashes a worker keeps.
CACHED_WORDS = 200_000

BATCHES = "batch long, ids array<long>, sizes array<int>, bytes long, texts binary"


def sizes_for(
    total: int, batch_bytes: int = BATCH_BYTES, bucket_bytes: int = BUCKET_BYTES, row_bytes: int = ROW_BYTES
) -> tuple[int, int]:
    """Bytes of a batch and of a bucket for so many bytes of text.

    There are total / batch * total / bucket rows, so with the least sizes they would grow with
    the square of the text. From total / row_bytes rows on both sizes grow with its root.
    """
    grow = max(1.0, math.sqrt(total * row_bytes / (batch_bytes * bucket_bytes)))
    return math.ceil(batch_bytes * grow), math.ceil(bucket_bytes * grow)


def batched(docs: DataFrame, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """A written table of batches of ``batch_bytes``, or larger ones for much text (``sizes_for``).

    A null text has size -1, so it is told from an empty one.
    """
    batch_bytes, _ = sizes_for(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0, batch_bytes)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        place, number = TaskContext.get().partitionId() << 32, 0
        ids: list[int | None] = []
        texts: list[bytes | None] = []
        held = 0

        def batch() -> pa.RecordBatch:
            sizes = [-1 if t is None else len(t) for t in texts]
            blob = pack.compress(b"".join(t for t in texts if t))
            columns = [[place + number], [ids], [sizes], [held], [blob]]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.binary()]
            names = ["batch", "ids", "sizes", "bytes", "texts"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for part in rows:
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                size = len(text or b"")
                if texts and held + size > batch_bytes:
                    yield batch()
                    number, ids, texts, held = number + 1, [], [], 0
                ids.append(doc_id)
                texts.append(text)
                held += size
        if texts:
            yield batch()

    return stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, BATCHES), "batches")


def texts_of(row: dict) -> list[bytes | None]:
    """The texts of a batch."""
    blob = zstandard.ZstdDecompressor().decompress(row["texts"], max_output_size=row["bytes"] or 1)
    out, at = [], 0
    for size in row["sizes"]:
        out.append(None if size < 0 else blob[at : at + size])
        at += max(size, 0)
    return out


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def word_hashes(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in a row, and the end of each document among them."""
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    flat = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    at, get = 0, worker_cache("hashes", _Hashes).__getitem__
    for words in texts:
        flat[at : at + len(words)] = np.fromiter(map(get, words), np.uint64, len(words))
        at += len(words)
    return flat, ends


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a hash over all of it."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


# Odd, so it has an inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def rolling(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the window of ``length`` words at each place, from running sums."""
    n = len(words)
    if n < length:
        return np.empty(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * _powers(_BASE, n), out=sums[1:])
    return mixed((sums[length:] - sums[:-length]) * _powers(_BACK, n - length + 1))


def starts(ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window of ``length`` words begins, and the first place of their document."""
    begins = np.concatenate([[0], ends]).astype(np.int64)[:-1]
    counts = np.maximum(ends - begins - length + 1, 0)
    first = np.repeat(begins, counts)
    within = np.arange(len(first)) - np.repeat(np.cumsum(counts) - counts, counts)
    return first + within, first


def bucket_bits(batches: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """log2 of the number of buckets of ``bucket_bytes``, or larger ones for much text, for all batches."""
    total = batches.agg(F.sum("bytes")).first()[0] or 0
    _, bucket_bytes = sizes_for(total, bucket_bytes=bucket_bytes)
    least = int(batches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(4, math.ceil(math.log2(max(total / bucket_bytes, least))))


def _packed(values: np.ndarray) -> bytes:
    """Numbers as planes of their bytes: small ones leave planes of zeros."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).reshape(-1)


def cut_key(keys: np.ndarray, bits: int, exact: bool) -> np.ndarray:
    """The part of a 64-bit hash that is compared: all of it, or 32 bits after the bucket's."""
    return keys if exact else keys >> np.uint64(32 - bits)


def ask(
    asking: DataFrame,
    hashes: Callable[[dict], tuple[np.ndarray, np.ndarray]],
    answer: Callable[[np.ndarray, np.ndarray], np.ndarray],
    bits: int,
    exact: bool = False,
    each: bool = False,
) -> DataFrame:
    """Answers for each batch (batch, replies) about its hashes, as a written table.

    ``hashes`` gives the sorted distinct keys of a batch, cut by ``cut_key``, and a number
    for each; ``answer`` gets the first place of each key among all that came to a bucket
    (sorted) and their numbers, and returns a small number for each key, or with ``each``
    for each number.
    """
    kind = np.uint64 if exact else np.uint32
    low = 64 - bits if exact else 32

    def deal(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            for row in part.to_pylist():
                keys, notes = hashes(row)
                if not len(keys):
                    continue
                buckets = (keys >> np.uint64(low)).astype(np.int64)
                inner = keys & np.uint64((1 << low) - 1)
                borders = np.flatnonzero(np.diff(buckets, prepend=-1))
                numbers, packed, noted = [], [], []
                for a, b in zip(borders, [*borders[1:], len(keys)], strict=True):
                    deltas = np.diff(inner[a:b], prepend=np.uint64(0)).astype(kind)
                    numbers.append(int(buckets[a]))
                    packed.append(_packed(deltas))
                    noted.append(_packed(notes[a:b].astype(np.uint32)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["batch"]] * len(numbers), pa.int64()),
                        pa.array(numbers, pa.int32()),
                        pa.array(packed, pa.binary()),
                        pa.array(noted, pa.binary()),
                    ],
                    ["batch", "bucket", "keys", "notes"],
                )

    def count(rows: pa.Table) -> pa.Table:
        keys = [np.cumsum(_unpacked(k, kind), dtype=kind) for k in rows["keys"].to_pylist()]
        notes = np.concatenate([_unpacked(n, np.uint32) for n in rows["notes"].to_pylist()])
        sizes = [len(k) for k in keys]
        flat = np.concatenate(keys)
        order = np.argsort(flat, kind="stable")
        ordered = flat[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        said = answer(first, notes[order])
        replies = np.empty(len(flat), np.uint8)
        said = said if each else np.repeat(said, np.diff(np.append(first, len(flat))))
        replies[order] = said.astype(np.uint8)
        pack = zstandard.ZstdCompressor(level=1)
        parts = np.split(replies, np.cumsum(sizes)[:-1])
        answers = pa.array([pack.compress(p.tobytes()) for p in parts], pa.binary())
        return rows.select(["batch", "bucket"]).append_column("reply", answers)

    dealt = asking.mapInArrow(deal, "batch long, bucket int, keys binary, notes binary")
    replies = dealt.groupBy("bucket").applyInArrow(count, "batch long, bucket int, reply binary")
    return stored(replies, "replies")


def with_replies(batches: DataFrame, replies: DataFrame, name: str) -> DataFrame:
    """Batches with the answers to them, put together by bucket."""
    parts = replies.groupBy(F.col("batch").alias("_batch")).agg(
        F.sort_array(F.collect_list(F.struct("bucket", "reply"))).alias(name)
    )
    return batches.join(parts, F.col("batch") == F.col("_batch"), "left").drop("_batch")


def replied(parts: list[dict] | None) -> np.ndarray:
    """The answers in the order of the keys."""
    read = zstandard.ZstdDecompressor()
    return np.concatenate([np.empty(0, np.uint8), *(np.frombuffer(read.decompress(p["reply"]), np.uint8) for p in parts or [])])
