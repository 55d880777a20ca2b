"""Hard negatives of vectors: scores by Strassen's multiplication, best ones in mergeable heaps.

Anchors are a stated part of the rows and are scored against all rows, in blocks:

1. Rows are packed to chunks of whole numbers. Chunks of candidates are dealt by hash over
   stripes, chunks of anchors over blocks, and each block meets each stripe in one task.
   Both have a size bound, so a task's memory has one; no row travels more than once for
   each block of the other side.
2. A task multiplies tiles of anchors and candidates by Strassen's seven products, padded
   with zeros to even sides and halved again and again. All of it is whole-number addition
   and multiplication modulo 2^64, so scores are exact.
3. The first round keeps the best rows of an anchor's own label, in a heap for each anchor.
   The second knows those positives, and keeps in a heap for each of their scores the best
   rows of other labels inside the window below it. Heaps of tiles merge inside the task,
   heaps of tasks by rank, which cuts each task's part before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fettle.llm.common import stored

SCALE = 256
ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 5
# A negative scores from this part of the positive's score, in hundredths, up to all of it.
LEAST_PERCENT = 80

# Rows of a chunk, and numbers (rows times components) of a stripe and of an anchor block.
CHUNK_ROWS = 1024
STRIPE_NUMBERS = 16_000_000
BLOCK_NUMBERS = 4_000_000
# Sides of a tile, and the side below which a product is not halved further.
TILE_ANCHORS = 512
TILE_ROWS = 4096
LEAF = 16

CHUNKS = "chunk long, n long, numbers long, packed binary"
FOUND = "anchor long, positive_score long, score long, id long, row long"


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Product of two int64 matrices modulo 2^64, by seven half-size products a level."""
    n, k, m = a.shape[0], a.shape[1], b.shape[1]
    if min(n, k, m) <= leaf:
        return a @ b
    if n % 2 or k % 2:
        a = np.pad(a, ((0, n % 2), (0, k % 2)))
    if k % 2 or m % 2:
        b = np.pad(b, ((0, k % 2), (0, m % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * l), np.int64)
    out[:i, :l] = p1 + p4 - p5 + p7
    out[:i, l:] = p3 + p5
    out[i:, :l] = p2 + p4
    out[i:, l:] = p1 - p2 + p3 + p6
    return out[:n, :m]


class Heaps:
    """The best ``size`` (score, place) of each group: higher scores, then smaller places.

    ``least`` is the score a group starts from; it rises to the last one kept when the group
    is full. Heaps of parts of the places merge by adding the one's content to the other.
    """

    def __init__(self, least: np.ndarray, size: int):
        self.least, self.size = least.copy(), size
        self.group = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.place = np.empty(0, np.int64)

    def add(self, group: np.ndarray, score: np.ndarray, place: np.ndarray) -> None:
        if not len(group):
            return
        group = np.concatenate([self.group, group])
        score = np.concatenate([self.score, score])
        place = np.concatenate([self.place, place])
        order = np.lexsort((place, ~score, group))
        at = np.arange(len(order))
        first = np.ones(len(order), bool)
        first[1:] = group[order][1:] != group[order][:-1]
        rank = at - np.maximum.accumulate(np.where(first, at, 0))
        kept = order[rank < self.size]
        self.group, self.score, self.place = group[kept], score[kept], place[kept]
        last = rank[rank < self.size] == self.size - 1
        self.least[self.group[last]] = self.score[last]


def first_hits(scores: np.ndarray, hit: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of hits; of a row with many, those that can be among its first ``size``."""
    if size < scores.shape[1] and hit.sum() > 4 * size * len(scores):
        shown = np.where(hit, scores, np.iinfo(np.int64).min)
        last = np.partition(shown, -size, axis=1)[:, -size, None]
        tied = hit & (scores == last)
        hit = hit & (scores > last) | tied & (np.cumsum(tied, axis=1) <= size)
    return np.nonzero(hit)


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of numbers, shorter ones padded with zeros."""
    ends = lists.offsets.to_numpy().astype(np.int64)
    sizes = np.diff(ends)
    width = int(sizes.max(initial=0))
    values = lists.values.to_numpy()[ends[0] : ends[-1]]
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(values)) - np.repeat(ends[:-1] - ends[0], sizes)] = values
    return out


def _narrow(m: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest type that holds them."""
    low, high = int(m.min(initial=0)), int(m.max(initial=0))
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return m.astype(kind)
    return m


def _pack(batch: pa.RecordBatch) -> bytes:
    """Columns row, id, label, windows and the vectors of a chunk."""
    m = _narrow(_matrix(batch.column("v")))
    side = batch.drop_columns(["v"]).append_column("width", pa.array([m.shape[1]] * len(m), pa.int32()))
    side = side.append_column("kind", pa.array([m.dtype.str] * len(m)))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, side.schema) as out:
        out.write_batch(side)
    head = sink.getvalue().to_pybytes()
    planes = np.ascontiguousarray(m.reshape(-1).view(np.uint8).reshape(m.size, -1).T).tobytes() if m.size else b""
    return zstandard.ZstdCompressor(level=1).compress(len(head).to_bytes(8, "little") + head + planes)


def _unpack(raw: bytes) -> tuple[pa.Table, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    cut = 8 + int.from_bytes(raw[:8], "little")
    side = pa.ipc.open_stream(raw[8:cut]).read_all()
    kind, width = np.dtype(side["kind"][0].as_py()), side["width"][0].as_py()
    planes = np.frombuffer(raw[cut:], np.uint8).reshape(kind.itemsize, -1)
    m = np.ascontiguousarray(planes.T).reshape(-1).view(kind)
    return side.drop_columns(["kind", "width"]), m.reshape(len(side), width)


def _joined(chunks: list[bytes], width: int = 0) -> tuple[pa.Table, np.ndarray]:
    """All chunks together, in the order of ties: by id, rows without one last."""
    sides, parts = zip(*map(_unpack, chunks), strict=True)
    width = max(width, *(p.shape[1] for p in parts))
    out = np.zeros((sum(map(len, parts)), width), np.result_type(*parts))
    at = 0
    for p in parts:
        out[at : at + len(p), : p.shape[1]] = p
        at += len(p)
    side = pa.concat_tables(sides)
    order = pc.sort_indices(side, [("id", "ascending"), ("row", "ascending")], null_placement="at_end")
    return side.take(order), out[order.to_numpy()]


def packed_chunks(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Chunks of rows (row, id, label, v and any other columns)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, chunk_rows):
                part = batch.slice(at, chunk_rows)
                packed = _pack(part)
                columns = [[number], [part.num_rows], [len(part.column("v").flatten())], [packed]]
                kinds = [pa.int64()] * 3 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["chunk", "n", "numbers", "packed"]
                )
                number += 1

    return rows.mapInArrow(run, CHUNKS)


def _met(anchors: DataFrame, rows: DataFrame, blocks: int, stripes: int, score: Callable) -> DataFrame:
    """``score`` of each block of anchors with each stripe of rows."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda n: F.pmod(F.xxhash64("chunk"), F.lit(n)).cast("int")
    left = anchors.select(own(blocks).alias("block"), every(stripes).alias("stripe"), "packed")
    right = rows.select(every(blocks).alias("block"), own(stripes).alias("stripe"), "packed")
    # A stated number, as the work of a task is not in proportion to its bytes.
    key = ["block", "stripe"]
    left, right = (df.repartition(blocks * stripes, *key) for df in (left, right))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        if not len(a) or not len(b):
            return pa.table([pa.array([], pa.int64())] * 5, ["anchor", "positive_score", "score", "id", "row"])
        return score(a["packed"].to_pylist(), b["packed"].to_pylist())

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, FOUND)


def _result(found: list[tuple[np.ndarray, ...]], side: pa.Table) -> pa.Table:
    """Rows (anchor row, positive score, score, place) with the id and row of the place."""
    parts = [np.concatenate(c) if c else np.empty(0, np.int64) for c in (zip(*found, strict=True) if found else [[]] * 4)]
    anchor, positive, score, place = (p.astype(np.int64) for p in parts)
    return pa.table(
        {"anchor": anchor, "positive_score": positive, "score": score, "id": side["id"].take(place), "row": side["row"].take(place)}
    )


def _padded(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a.astype(np.int64), ((0, 0), (0, width - a.shape[1])))


def best_positives(chunks_a: list[bytes], chunks_b: list[bytes], size: int = POSITIVES) -> pa.Table:
    """The best other rows of each anchor's label among the rows."""
    of_a, a = _joined(chunks_a)
    of_b, b = _joined(chunks_b, a.shape[1])
    row_a, row_b = of_a["row"].to_numpy(), of_b["row"].to_numpy()
    label_a, label_b = of_a["label"].to_numpy(), of_b["label"].to_numpy()
    by_a, by_b = np.argsort(label_a, kind="stable"), np.argsort(label_b, kind="stable")
    found = []
    for label in np.unique(label_a):
        mine = by_a[np.searchsorted(label_a[by_a], label) : np.searchsorted(label_a[by_a], label, "right")]
        theirs = by_b[np.searchsorted(label_b[by_b], label) : np.searchsorted(label_b[by_b], label, "right")]
        for i in range(0, len(mine), TILE_ANCHORS):
            tile = mine[i : i + TILE_ANCHORS]
            heaps = Heaps(np.full(len(tile), np.iinfo(np.int64).min), size)
            left = _padded(a[tile], b.shape[1])
            for j in range(0, len(theirs), TILE_ROWS):
                places = theirs[j : j + TILE_ROWS]
                scores = strassen(left, b[places].astype(np.int64).T)
                keep = (scores >= heaps.least[:, None]) & (row_b[places] != row_a[tile][:, None])
                x, y = first_hits(scores, keep, size)
                heaps.add(x, scores[x, y], places[y])
            found.append((row_a[tile][heaps.group], heaps.score, heaps.score, heaps.place))
    return _result(found, of_b)


def best_negatives(
    chunks_a: list[bytes], chunks_b: list[bytes], size: int = NEGATIVES, percent: int = LEAST_PERCENT
) -> pa.Table:
    """The best rows of other labels inside the window below each score in ``windows``."""
    of_a, a = _joined(chunks_a)
    of_b, b = _joined(chunks_b, a.shape[1])
    row_a, label_a, label_b = of_a["row"].to_numpy(), of_a["label"].to_numpy(), of_b["label"].to_numpy()
    windows = of_a["windows"].combine_chunks()
    sizes = np.diff(windows.offsets.to_numpy())
    tops, starts = windows.values.to_numpy(), np.concatenate([[0], np.cumsum(sizes)])
    # 80 p <= 100 n, rounded up to whole numbers.
    floors = np.array([-((-percent * int(p)) // 100) for p in tops.tolist()], np.int64)
    found = []
    for i in range(0, len(a), TILE_ANCHORS):
        tile = np.arange(i, min(i + TILE_ANCHORS, len(a)))
        left = _padded(a[tile], b.shape[1])
        n_th = [tile[sizes[tile] > k] for k in range(int(sizes[tile].max(initial=0)))]
        heaps = [Heaps(floors[starts[t] + k], size) for k, t in enumerate(n_th)]
        for j in range(0, len(b), TILE_ROWS):
            scores = strassen(left, b[j : j + TILE_ROWS].astype(np.int64).T)
            other = label_b[j : j + TILE_ROWS] != label_a[tile][:, None]
            for k, (t, heap) in enumerate(zip(n_th, heaps, strict=True)):
                mine = scores[t - i]
                inside = (mine >= heap.least[:, None]) & (mine <= tops[starts[t] + k][:, None])
                x, y = first_hits(mine, inside & other[t - i], size)
                heap.add(x, mine[x, y], y + j)
        for k, (t, heap) in enumerate(zip(n_th, heaps, strict=True)):
            of = t[heap.group]
            found.append((row_a[of], tops[starts[of] + k], heap.score, heap.place))
    return _result(found, of_b)


def whole_vectors(vectors: DataFrame, relabel: Column | None = None, scale: int = SCALE) -> DataFrame:
    """Rows that take part: id, label and v, the components times ``scale``, rounded down."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(~bad)
    v = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    label = F.col("label") if relabel is None else relabel
    return rows.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), v.alias("v"))


def _best(found: DataFrame, group: list[str], size: int, name: str) -> DataFrame:
    """Merge the heaps of all tasks: the first ``size`` of each group with their rank."""
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= size)


def hard_negatives(
    rows: DataFrame,
    anchor: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percent: int = LEAST_PERCENT,
    stripe_numbers: int = STRIPE_NUMBERS,
    block_numbers: int = BLOCK_NUMBERS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` are as ``whole_vectors`` gives them; ``anchor`` is the condition of an anchor,
    by default an id divisible by 100. A score is an inner product; higher ones come first,
    ties by smaller id. An anchor's positives are the best other rows of its label; each has
    the best rows of other labels that score from ``percent`` hundredths of its score up to
    all of it. A positive without such rows gives no row.

    Rows without an id are candidates, last among ties, and never anchors. Each of several
    equal rows is a row of its own. A vector that is shorter than another is filled up with
    zeros. Components and scores are 64-bit numbers: components beyond are cut to the
    largest, scores beyond wrap around. An empty table gives an empty result.
    """
    anchor = F.col("id") % ANCHOR_EVERY == 0 if anchor is None else anchor
    rows = stored(rows.select("id", "label", "v").withColumn("row", F.monotonically_increasing_id()), "vectors")
    chunks = stored(packed_chunks(rows, chunk_rows), "candidates")
    ours = rows.where(anchor)
    asking = stored(packed_chunks(ours, chunk_rows), "anchors")

    def count(chunks: DataFrame) -> int:
        return chunks.agg(F.sum("numbers")).first()[0] or 0

    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stripes = max(math.ceil(count(chunks) / stripe_numbers), least)
    blocks = max(1, math.ceil(count(asking) / block_numbers))

    same = _met(asking, chunks, blocks, stripes, lambda a, b: best_positives(a, b, positives))
    best = stored(_best(same, ["anchor"], positives, "place"), "positives")

    windows = best.groupBy("anchor").agg(F.sort_array(F.collect_set("score")).alias("windows"))
    asking = ours.join(windows, F.col("row") == F.col("anchor")).drop("anchor")
    asking = stored(packed_chunks(asking, chunk_rows), "windows")
    others = _met(asking, chunks, blocks, stripes, lambda a, b: best_negatives(a, b, negatives, percent))
    below = _best(others, ["anchor", "positive_score"], negatives, "rank")

    named = ours.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    wanted = best.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        below.select("anchor", "positive_score", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(wanted, ["anchor", "positive_score"])
        .join(named, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
