"""Substring dedup by fixed-block anchors.

Every document is cut into blocks of a fixed number of words; the blocks are the index. The
rolling window of a block's length at every place of every document probes it. A repeated
passage of at least twice a block less one holds a whole block of one of its places, so its
other places hit that block: places that hit nothing are in no such passage.

Around each hit the windows of full length are compared exactly, and those that begin at
two places or more are joined to maximal repeats, whose words are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fettle.llm import exchange as ex

WINDOW = 35
_SECOND = np.uint64(0xD6E8FEB86659FD93)
SCHEMA = "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start:int,`end`:int>>"


def _words(row: dict) -> list[list[bytes]]:
    """Words of each text of a batch; bytes.split() divides at ASCII white space alone."""
    return [t.split() if t else [] for t in ex.texts_of(row)]


def _probes(words: np.ndarray, ends: np.ndarray, block: int, bits: int):
    """Distinct keys of the rolling windows, which of them are blocks, how often each comes,
    the places, and the key of each place."""
    places, first = ex.starts(ends, block)
    keys = ex.cut_key(ex.rolling(words, block)[places], bits, False)
    found, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    indexed = np.zeros(len(found), bool)
    indexed[inverse[(places - first) % block == 0]] = True
    return found, indexed, counts, places, inverse


def _candidates(words: np.ndarray, ends: np.ndarray, replies: np.ndarray, block: int, window: int, bits: int):
    """Places of full windows with a hit inside, their keys, and a second number of 31 bits.

    The second one comes from other values of the words, so windows that agree in the key by
    chance agree in it by another chance of one in 2^31.
    """
    _, _, _, places, inverse = _probes(words, ends, block, bits)
    hits = np.zeros(len(words) + 1, np.int64)
    hits[places[replies[inverse] > 0] + 1] = 1
    hits = np.cumsum(hits)
    full, _ = ex.starts(ends, window)
    full = full[hits[full + window - block + 1] > hits[full]]
    if not len(full):
        return full, np.empty(0, np.uint64), np.empty(0, np.uint64)
    other = ex.rolling(ex.mixed(words ^ _SECOND), window)[full] >> np.uint64(33)
    return full, ex.rolling(words, window)[full], other


def _distinct(keys: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the distinct pairs, sorted, which pair each one is, and how often each comes."""
    order = np.lexsort((other, keys))
    new = np.ones(len(order), bool)
    new[1:] = (keys[order][1:] != keys[order][:-1]) | (other[order][1:] != other[order][:-1])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which, np.diff(np.append(np.flatnonzero(new), len(order)))


def remove_repeats(docs: DataFrame, window: int = WINDOW, batch_bytes: int = ex.BATCH_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words joined by one blank) and the removed spans.

    Words are runs of anything but blanks and ASCII control white space. Each word that a
    window of ``window`` words covers is removed if the window's words also begin anywhere
    else, in the same document or another; windows are judged on the input. A null text has
    no words; equal rows repeat each other. Only doc_id and text are read. An empty table
    gives an empty result.

    Windows are compared by 95 bits of two hashes: in a table of n repeated windows a wrong
    match has a chance of n^2 / 2^96.
    """
    block = (window + 1) // 2
    batches = ex.batched(docs, batch_bytes)
    bits = ex.bucket_bits(batches)

    def probes(row: dict) -> tuple[np.ndarray, np.ndarray]:
        words, ends = ex.word_hashes(_words(row))
        keys, indexed, counts, _, _ = _probes(words, ends, block, bits)
        return keys, indexed.astype(np.uint32) | (counts > 1).astype(np.uint32) << 1

    def hit(first: np.ndarray, notes: np.ndarray) -> np.ndarray:
        """A block of the index that begins at two places at least."""
        often = np.diff(np.append(first, len(notes))) + np.maximum.reduceat(notes >> 1, first) > 1
        return often & (np.bitwise_or.reduceat(notes, first) & 1 > 0)

    def fulls(row: dict) -> tuple[np.ndarray, np.ndarray]:
        words, ends = ex.word_hashes(_words(row))
        _, keys, other = _candidates(words, ends, ex.replied(row["hits"]), block, window, bits)
        places, _, counts = _distinct(keys, other)
        return keys[places], other[places].astype(np.uint32) | (counts > 1).astype(np.uint32) << 31

    def repeated(first: np.ndarray, notes: np.ndarray) -> np.ndarray:
        """For each window whether it comes often in its batch, or in another one too."""
        other = notes & 0x7FFFFFFF
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(notes))))
        _, which, counts = _distinct(group, other)
        return (counts[which] > 1) | (notes >> 31 > 0)

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            for row in part.to_pylist():
                texts = _words(row)
                words, ends = ex.word_hashes(texts)
                places, keys, other = _candidates(words, ends, ex.replied(row["hits"]), block, window, bits)
                places = places[ex.replied(row["repeats"])[_distinct(keys, other)[1]] > 0]
                cover = np.zeros(len(words) + window + 1, np.int32)
                np.add.at(cover, places, 1)
                np.add.at(cover, places + window, -1)
                gone = np.cumsum(cover)[: len(words)] > 0
                yield _result(row["ids"], texts, gone, ends)

    asked = ex.with_replies(batches, ex.ask(batches, probes, hit, bits), "hits")
    full = ex.with_replies(asked, ex.ask(asked, fulls, repeated, bits, exact=True, each=True), "repeats")
    return full.mapInArrow(cut, SCHEMA)


def _result(ids: list, texts: list[list[bytes]], gone: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    kept, removed, spans = [], [], []
    for words, end in zip(texts, ends.tolist(), strict=True):
        mine = gone[end - len(words) : end]
        borders = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0))
        spans.append([{"start": a, "end": b} for a, b in borders.reshape(-1, 2).tolist()])
        removed.append(int(mine.sum()))
        if removed[-1]:
            words = [words[i] for i in np.flatnonzero(~mine)]
        kept.append(b" ".join(words).decode())
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array([len(w) for w in texts], pa.int64()),
            pa.array(removed, pa.int64()),
            pa.array(kept, pa.string()),
            pa.array(spans, span),
        ],
        ["doc_id", "n_words", "n_removed", "kept", "spans"],
    )
