"""Language identification by compression.

Each language is a zstandard raw-content dictionary of sample text. A text is encoded once
with every dictionary and takes the language of the smallest encoding; a narrow lead over
the second means that no language fits well. Sizes are whole bytes, so short texts often
tie: such a text is encoded again with each of ``PARTS`` parts of every dictionary, and the
mean sizes decide.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fettle.llm.common import worker_cache

LEVEL = 6
# Texts are encoded in blocks of this many bytes, each from the dictionary alone: else a
# long text would soon be its own dictionary.
BLOCK = 2048
# The sample of a language: so many documents and characters of each at most.
SAMPLE_DOCS = 128
SAMPLE_CHARS = 1024
SAMPLE_SHARDS = 256
# Parts of a dictionary that measure a tied text again, of so many bytes at least.
PARTS = 16
PART_BYTES = 64
# Least lead of the smallest encoding, as a part of the second smallest.
LEAST_LEAD = 0.005

UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_NO_LETTERS = re.compile(r"[\W\d_]+")
FOUND = T.StructType().add("lang_pred", "string").add("score", "double").add("accepted", "boolean")


def sample_dictionaries(
    labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS
) -> dict[str, bytes]:
    """A dictionary for each language from a bounded sample of text and lang.

    The documents of a language are taken in the order of a hash of their text, equal texts
    once; the driver gets sample_docs * sample_chars characters a language at most.
    """
    rows = labelled.where("lang is not null and length(trim(text)) > 0")
    # Texts are compared by what the sample would hold of them.
    rows = rows.select("lang", F.substring("text", 1, sample_chars).alias("part"))
    rows = rows.withColumn("order", F.xxhash64("part")).groupBy("lang", "order").agg(F.first("part").alias("part"))
    # Every task hands on sample_docs rows of a language at most, and so does every shard, so
    # the task that sees a whole language has a bounded number of rows.
    rows = rows.withColumn("shard", F.pmod("order", F.lit(SAMPLE_SHARDS)))
    for keys in (["lang", "shard"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("order"))
        rows = rows.withColumn("rank", rank).where(F.col("rank") <= sample_docs)
    parts: dict[str, list[tuple[int, str]]] = {}
    for r in rows.select("lang", "order", "part").collect():
        parts.setdefault(r["lang"], []).append((r["order"], r["part"]))
    return {k: letters("\n".join(p for _, p in sorted(v))) for k, v in sorted(parts.items())}


def letters(text: str) -> bytes:
    """What is encoded: words in lower case with one blank between them."""
    return _NO_LETTERS.sub(" ", text.lower()).encode("utf-8", "replace")


class Encoders:
    """Encoded sizes of texts by language."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        self.names = list(dictionaries)
        self.all = [_encoder(d, level) for d in dictionaries.values()]
        parts = max(1, min([PARTS, *(len(d) // PART_BYTES for d in dictionaries.values())]))
        self.parts = [[_encoder(p, level) for p in _cut(d, parts)] for d in dictionaries.values()]

    def sizes(self, text: str) -> list[float]:
        raw = letters(text)
        blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
        whole = [_size([e], blocks) for e in self.all]
        if len(whole) > 1 and whole.count(min(whole)) > 1:
            return [_size(parts, blocks) for parts in self.parts]
        return whole


def _encoder(dictionary: bytes, level: int):
    import zstandard

    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    content.precompute_compress(level=level)
    return zstandard.ZstdCompressor(
        level=level, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False
    )


def _cut(dictionary: bytes, parts: int) -> list[bytes]:
    borders = [len(dictionary) * i // parts for i in range(parts + 1)]
    return [dictionary[a:b] for a, b in zip(borders, borders[1:])]


def _size(encoders: list, blocks: list[bytes]) -> float:
    """Mean size of all blocks over some encoders."""
    return sum(len(e.compress(b)) for e in encoders for b in blocks) / len(encoders)


def identify(docs: DataFrame, dictionaries: dict[str, bytes], least_lead: float = LEAST_LEAD) -> DataFrame:
    """Adds lang_pred, score and accepted to each row (in place of any of that name), from its
    whole text alone.

    The score is the lead of the smallest encoding over the second smallest, as a part of
    the second; a document with a lead under ``least_lead`` is not accepted. Without a
    letter, or where there is no dictionary, the language is ``und`` with score 0, not
    accepted. With a single dictionary the second size is that of the text itself. A text that
    ties is measured again by parts of the dictionaries; what ties then too goes to the first
    language by name, with score 0. Repeated rows stay as they are.
    """
    docs = docs.drop(*FOUND.names)
    names, kept = list(dictionaries), docs.columns
    place = kept.index("text")

    def predict(text: str | None, encoders: Encoders) -> tuple[str, float, bool]:
        if not text or not names or not _LETTER.search(text):
            return UNKNOWN, 0.0, False
        sizes = encoders.sizes(text)
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        second = sizes[order[1]] if len(order) > 1 else max(len(letters(text)), sizes[0])
        lead = (second - sizes[order[0]]) / second
        return names[order[0]], lead, lead >= least_lead

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = worker_cache(f"encoders {crc32(repr(dictionaries).encode())}", lambda: Encoders(dictionaries))
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = [predict(t, encoders) for t in part.column(place).to_pylist()]
                langs, scores, accepted = zip(*found)
                added = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], [*kept, "lang_pred", "score", "accepted"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *FOUND.fields]))


def held_out(doc_id):
    """Whether a document is kept from learning; one without an id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
