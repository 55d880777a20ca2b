"""Exact Jaccard join of documents on word n-grams, in the metric space of their sets.

One minus the Jaccard similarity is a metric, and a link is a distance of at most e.

1. Every document learns from all others, by ``exchange``, how many documents have each of
   its shingles. A linked document shares all but a part e of its shingles, so a document
   with more that nobody else has is linked with nothing. Equal sets become one node.
2. Single shingles, the rarest first, place the nodes: two linked nodes share one of the
   first few of each. Of the nodes that share one, the first is the pivot of a region, and
   the region holds all nodes that meet the pivot this way. A node near a border is so
   copied to several regions, and any two linked nodes meet in one of them.
3. The distance of each node to its pivots is computed, which links most groups at once.
   By the triangle inequality two nodes of a region can only be linked if their distances
   to the pivot differ by e at most: large regions are cut into rings of that width, each
   taken with the next, and rings that are still too large are joined in blocks.
4. Inside a task a region is divided again and again: new pivots, a cell for the nodes
   nearest to each, nodes copied to all cells that are within e of their nearest, and one
   cell for nodes far from all, until a cell is small or in one component. What is left is
   compared exactly, through the shingles shared. Only links that join two components are
   given out, so a group of n copies makes n - 1 links at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fettle.llm import exchange as ex
from fettle.llm.common import stored

WORDS = 4
PERCENT = 85
# Shingles of a region, or a block of one, that a single task joins.
TASK_SHINGLES = 2_000_000
LEAF = 64
PIVOTS = 8
_EPS = 1e-9


def shingle_sets(texts: list[bytes | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingle hashes of each text in a row, sorted, and the text of each.

    A-Z count as lower case. A text of fewer words than a shingle has one shingle.
    """
    split = [t.lower().split() if t else [] for t in texts]
    flat, ends = ex.word_hashes(split)
    places, _ = ex.starts(ends, words)
    h = np.zeros(len(places), np.uint64)
    for k in range(words):
        h = ex.mixed(h + flat[places + k]) if len(places) else h
    owner = np.searchsorted(ends, places, side="right")
    short = [i for i, w in enumerate(split) if 0 < len(w) < words]
    few = np.zeros(len(short), np.uint64)
    for at, i in enumerate(short):
        value = np.array([len(split[i])], np.uint64)
        for word in flat[ends[i] - len(split[i]) : ends[i]]:
            value = ex.mixed(value + word)
        few[at] = ~value[0]
    h, owner = np.concatenate([h, few]), np.concatenate([owner, np.array(short, owner.dtype)])
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], owner[new]


def node_rows(row: dict, words: int, percent: int, bits: int) -> pa.RecordBatch:
    """For each text of a batch its number of shingles and, if it may have a link, its set,
    a digest of it and the shingles that place it."""
    import hashlib

    texts = ex.texts_of(row)
    h, owner = shingle_sets(texts, words)
    keys = ex.cut_key(h, bits, False)
    rarity = ex.replied(row["replies"])[np.unique(keys, return_inverse=True)[1]]
    sizes = np.bincount(owner, minlength=len(texts))
    shared = np.bincount(owner, weights=rarity > 0, minlength=len(texts)).astype(np.int64)
    may = (sizes > 0) & (100 * shared >= percent * sizes)
    ends = np.cumsum(sizes)
    digests, sets, first = [], [], []
    for i, (end, size) in enumerate(zip(ends.tolist(), sizes.tolist(), strict=True)):
        if not may[i]:
            digests.append(None), sets.append(None), first.append(None)
            continue
        mine, rare = h[end - size : end], rarity[end - size : end]
        place = np.lexsort((mine, rare))[: size - (percent * size + 99) // 100 + 1]
        digests.append(hashlib.blake2b(mine.tobytes(), digest_size=16).digest())
        sets.append(mine.view(np.int64))
        first.append(mine[place][rare[place] > 0].view(np.int64))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(row["ids"], pa.int64()),
            pa.array(sizes.tolist(), pa.int64()),
            pa.array(digests, pa.binary()),
            pa.array(sets, pa.list_(pa.int64())),
            pa.array(first, pa.list_(pa.int64())),
        ],
        ["doc_id", "n", "digest", "shingles", "first"],
    )


class Region:
    """Nodes of a region, joined exactly; links holds one link for each union."""

    def __init__(self, sets: list[np.ndarray], labels: list[int], percent: int):
        self.percent, self.e = percent, 1 - percent / 100 + _EPS
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.ends = np.cumsum(self.sizes)
        _, self.tokens = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(self.tokens, kind="stable")
        self.posted = owner[order]
        self.borders = np.searchsorted(self.tokens[order], np.arange(self.tokens.max() + 2))
        _, self.root = np.unique(np.array(labels), return_inverse=True)
        self.links: list[tuple[int, int]] = []

    def shared(self, x: int) -> np.ndarray:
        """Shingles that x has in common with every node."""
        mine = self.tokens[self.ends[x] - self.sizes[x] : self.ends[x]]
        a, b = self.borders[mine], self.borders[mine + 1]
        at = np.repeat(a - np.concatenate([[0], np.cumsum(b - a)[:-1]]), b - a) + np.arange((b - a).sum())
        return np.bincount(self.posted[at], minlength=len(self.sizes))

    def distances(self, x: int, among: np.ndarray) -> np.ndarray:
        """Distances of x to some nodes; links it to those in reach that are in other components."""
        common = self.shared(x)[among]
        either = self.sizes[x] + self.sizes[among] - common
        for y in among[100 * common >= self.percent * either]:
            if self.root[y] != self.root[x]:
                self.root[self.root == self.root[y]] = self.root[x]
                self.links.append((x, int(y)))
        return 1 - common / either

    def leaf(self, nodes: np.ndarray) -> None:
        """Compare all nodes outside the largest component with the others."""
        names, counts = np.unique(self.root[nodes], return_counts=True)
        for x in nodes[self.root[nodes] != names[counts.argmax()]]:
            others = nodes[self.root[nodes] != self.root[x]]
            if len(others):
                self.distances(int(x), others)

    def join(self, nodes: np.ndarray) -> None:
        if len(nodes) < 2 or (self.root[nodes] == self.root[nodes[0]]).all():
            return
        if len(nodes) <= LEAF:
            self.leaf(nodes)
            return
        tried = nodes[np.linspace(0, len(nodes) - 1, PIVOTS).astype(int)]
        pivots: list[np.ndarray] = []
        for p in tried:
            d = self.distances(int(p), nodes)
            # Pivots two reaches apart, so that a tight group falls into one cell.
            if all(d[np.searchsorted(nodes, q)] > 2 * self.e for q, _ in pivots):
                pivots.append((p, d))
        left = ~np.isin(nodes, tried)
        table = np.stack([d for _, d in pivots])[:, left]
        rest, nearest = nodes[left], table.min(axis=0)
        cells = [rest[(d <= nearest + self.e) & (d < 1)] for d in table]
        cells.append(rest[nearest > 1 - self.e - 2 * _EPS])
        for cell in cells:
            if len(cell) > 0.9 * len(nodes):
                self.leaf(cell)
            else:
                self.join(cell)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes with links (a, b): the smallest node that is reachable.

    Each round takes the smallest label among the neighbours and then the label of the
    label, so the rounds grow with the logarithm of a chain's length.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("component")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
        near = labels.join(seen.agg(F.min("component").alias("_near")), "node")
        near = near.select("node", F.col("component").alias("_was"), F.least("component", "_near").alias("_now"))
        jump = labels.select(F.col("node").alias("_now"), F.col("component").alias("_then"))
        after = near.join(jump, "_now").select("node", "_was", F.least("_now", "_then").alias("component"))
        after = stored(after, "labels")
        labels = after.select("node", "component")
        if after.where("component <> _was").isEmpty():
            return labels


def verified(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with their distance and whether they are linked."""
    of_a = nodes.select(F.col("node").alias("a"), F.col("shingles").alias("_a"))
    of_b = nodes.select(F.col("node").alias("b"), F.col("shingles").alias("_b"))
    both = pairs.join(of_a, "a").join(of_b, "b")
    common = F.size(F.array_intersect("_a", "_b"))
    counted = both.select("a", "b", common.alias("_common"), (F.size("_a") + F.size("_b") - common).alias("_either"))
    return counted.select(
        "a",
        "b",
        (1 - F.col("_common") / F.col("_either")).alias("distance"),
        (100 * F.col("_common") >= percent * F.col("_either")).alias("linked"),
    )


def _tasks(members: DataFrame, percent: int, task_shingles: int) -> DataFrame:
    """Members of regions dealt to tasks (region, ring, i, j) that fit one worker's memory."""
    reach = 1 - percent / 100 + 1e-6
    size = members.groupBy("pivot").agg(F.sum("n").alias("_n"), F.min("label").alias("_lo"), F.max("label").alias("_hi"))
    open_ = size.where("_lo <> _hi").select("pivot", (F.col("_n") > task_shingles).alias("_large"))
    ring = F.floor(F.col("distance") / reach).cast("int")
    rings = F.when(F.col("_large"), F.array_distinct(F.array(ring, F.greatest(ring - 1, F.lit(0))))).otherwise(F.array(F.lit(-1)))
    dealt = members.join(open_, "pivot").withColumn("ring", F.explode(rings)).drop("_large")
    size = dealt.groupBy("pivot", "ring").agg(F.sum("n").alias("_n"), F.min("label").alias("_lo"), F.max("label").alias("_hi"))
    # Two blocks meet in a task, so each has half of what it may hold.
    blocks = F.when(F.col("_n") <= task_shingles, 1).otherwise(F.ceil(2 * F.col("_n") / task_shingles)).cast("int")
    size = size.where("_lo <> _hi").select("pivot", "ring", blocks.alias("_blocks"))
    dealt = dealt.join(size, ["pivot", "ring"])
    own = F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int")
    pair = F.transform(
        F.sequence(F.lit(0), F.col("_blocks") - 1), lambda k: F.struct(F.least(k, own).alias("i"), F.greatest(k, own).alias("j"))
    )
    return dealt.withColumn("_pair", F.explode(pair)).select("pivot", "ring", "_pair.i", "_pair.j", "node", "label")


def find_links(nodes: DataFrame, percent: int, task_shingles: int = TASK_SHINGLES) -> DataFrame:
    """Links (a, b) that give all components of nodes (node, n, shingles, first)."""
    placed = nodes.select("node", "n", F.explode("first").alias("shingle"))
    pivots = placed.groupBy("shingle").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("_met"))
    met = placed.join(pivots.where("_met > 1"), "shingle").where("node <> pivot")
    members = stored(met.select("node", "n", "pivot").distinct(), "regions")
    near = verified(members.select(F.col("node").alias("a"), F.col("pivot").alias("b")), nodes, percent)
    near = stored(near, "near")

    label = near.where("linked").groupBy(F.col("a").alias("_node")).agg(F.min("b").alias("_label"))
    known = members.join(near.select(F.col("a").alias("node"), F.col("b").alias("pivot"), "distance"), ["node", "pivot"])
    known = known.join(label, F.col("node") == F.col("_node"), "left")
    known = known.select("pivot", "node", "n", "distance", F.coalesce("_label", "node").alias("label"))
    tasks = _tasks(stored(known, "known"), percent, task_shingles)
    filled = tasks.join(nodes.select("node", "shingles"), "node")

    def join(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("node").combine_chunks()
        sets = [s.values.to_numpy() for s in rows["shingles"]]
        region = Region(sets, rows["label"].to_pylist(), percent)
        region.join(np.arange(len(sets)))
        ids = rows["node"].to_numpy()
        ends = np.array(region.links, np.int64).reshape(-1, 2)
        return pa.table({"a": ids[ends[:, 0]], "b": ids[ends[:, 1]]})

    inside = filled.groupBy("pivot", "ring", "i", "j").applyInArrow(join, "a long, b long")
    return near.where("linked").select("a", "b").unionByName(inside)


def jaccard_components(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, batch_bytes: int = ex.BATCH_BYTES
) -> DataFrame:
    """doc_id, n_shingles and component_id for each row.

    Two documents are linked when their sets of ``words``-word shingles have a Jaccard
    similarity of ``percent`` hundredths at least; component_id is the smallest doc_id that
    links reach. A text of fewer words is one shingle; without words, or null, it has none
    and is linked with nothing. Equal rows are linked. Rows without an id take part, and
    have a null component if they reach no id. Only doc_id and text are read; an empty table
    gives an empty result. Shingles are compared by 64-bit hashes, sets by 128 bits.
    """
    batches = ex.batched(docs, batch_bytes)
    bits = ex.bucket_bits(batches)

    def hashes(row: dict) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(ex.cut_key(shingle_sets(ex.texts_of(row), words)[0], bits, False), return_counts=True)

    def rarity(first: np.ndarray, notes: np.ndarray) -> np.ndarray:
        """Whole part of log2 of the number of documents."""
        return np.log2(np.add.reduceat(notes.astype(np.int64), first)).astype(np.uint8)

    def rows_of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            for row in part.to_pylist():
                yield node_rows(row, words, percent, bits)

    asked = ex.with_replies(batches, ex.ask(batches, hashes, rarity, bits), "replies")
    found = asked.mapInArrow(rows_of, "doc_id long, n long, digest binary, shingles array<long>, first array<long>")
    found = stored(found.withColumn("row", F.monotonically_increasing_id()), "sets")

    equal = found.where("digest is not null").groupBy("digest").agg(F.min("row").alias("node"), F.min("doc_id").alias("low"))
    equal = stored(equal, "equal")
    nodes = found.where("digest is not null").join(equal.select(F.col("node").alias("row"), "node"), "row")
    nodes = stored(nodes.select("node", "n", "shingles", "first"), "nodes")

    of = components(find_links(nodes, percent))
    named = equal.join(of, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(least, "component").select(F.col("digest").alias("_digest"), "component_id")
    alone = found.where("digest is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    others = found.where("digest is not null").select("doc_id", "n", "digest").join(named, F.col("digest") == F.col("_digest"))
    return alone.unionByName(others.select("doc_id", F.col("n").alias("n_shingles"), "component_id"))
