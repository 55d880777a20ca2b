"""Mixing of sources to target weights by a proportionate-fair schedule.

Time is a row of slots, one block each. With weight w, block j of a source is released at
slot floor(j / w) and is due before slot ceil((j + 1) / w); of the released blocks the one
due first takes the slot. As the weights add up to one, every block meets its window, and
at each slot every source is less than one block away from its target.

Weights are whole numbers of 2 ** -40, so they differ from the targets by less than a block
in 10 ** 12 slots. Slots are worked out in frames that do not wait for each other: which
blocks are done before a frame follows from its first slot alone (``started``), so the
windows run on over the ends of frames and no error adds up.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fettle.llm.common import stored, with_rank

FRAME = 4096
UNITS = 1 << 40
PLACES = ["slot", "epoch", "release", "deadline"]
TEMPERATURE = 0.7
# A block's window has 1 / weight slots, and the driver works out one window at a time.
LEAST_WEIGHT = 2**-20
# The blocks of a pool are ranked in this many parts of its time at most.
POOL_PARTS = 8192


def started(shares: dict[str, int], at: int) -> dict[str, int]:
    """Blocks of each source that are done before slot ``at``; their sum is ``at``.

    A source has done floor or ceil of its target. Some blocks have windows on both sides of
    ``at``. Of these the ones due first are done, as long as the slots before, from their
    release on, have room for them beside the blocks that are due by ``at``. A schedule that
    meets all windows exists on both sides: any set with room will do before, and after it
    no set leaves fewer blocks that are due early.
    """
    whole = sum(shares.values())
    done = {k: at * s // whole for k, s in shares.items()}
    open_ = [(-(-(done[k] + 1) * whole // s), k, done[k] * whole // s) for k, s in shares.items() if at * s % whole]
    if not open_:
        return done
    first = min(release for _, _, release in open_)
    due = np.zeros(at - first, np.int64)  # blocks due by ``at``, by release
    for name, share in shares.items():
        for block in range(-(-first * share // whole), done[name]):
            due[block * whole // share - first] += 1
    room = np.arange(at - first, 0, -1) - np.cumsum(due[::-1])[::-1]
    left = at - sum(done.values())
    for _, name, release in sorted(open_):
        before = room[: release - first + 1]
        if left and before.min() > 0:
            before -= 1
            left -= 1
            done[name] += 1
    return done


def frame_schedule(
    shares: dict[str, int], start: int = 0, end: int | None = None
) -> list[tuple[str, int, int, int, int]]:
    """(source, block, slot, release, deadline) of the slots from ``start`` to ``end``.

    A source's weight is its part of all shares. Without ``end`` the schedule goes on for as
    many slots as there are shares.
    """
    whole = sum(shares.values())
    end = start + whole if end is None else end
    done, until = started(shares, start), started(shares, end)
    share_of = {name: share for name, share in shares.items() if done[name] < until[name]}

    def released(name: str, block: int) -> int:
        return block * whole // share_of[name]

    waiting = [(max(start, released(name, done[name])), name, done[name]) for name in share_of]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    out = []
    for slot in range(start, end):
        while waiting and waiting[0][0] <= slot:
            _, name, block = heapq.heappop(waiting)
            # What is done by the end has to be done inside.
            heapq.heappush(ready, (min(end, -(-(block + 1) * whole // share_of[name])), name, block))
        _, name, block = heapq.heappop(ready)
        out.append((name, block, slot, released(name, block), -(-(block + 1) * whole // share_of[name])))
        if block + 1 < until[name]:
            # A block also waits for the one before it.
            heapq.heappush(waiting, (max(slot + 1, released(name, block + 1)), name, block + 1))
    return out


def whole_shares(weights: dict[str, float], frame: int = FRAME) -> dict[str, int]:
    """Shares of a frame that add up to it, one at least, by largest remainder."""
    total = sum(weights.values())
    exact = {k: v * frame / total for k, v in weights.items()}
    shares = {k: max(1, int(v)) for k, v in exact.items()}
    by_rest = sorted(exact, key=lambda k: (int(exact[k]) - exact[k], k))
    at = 0
    while (left := frame - sum(shares.values())) != 0:
        if left > 0:
            shares[by_rest[at % len(by_rest)]] += 1
            at += 1
        else:
            shares[max(shares, key=lambda k: (shares[k], k))] -= 1
    return shares


class Pool:
    """The order of blocks inside a pool of any number of sources.

    ``sources`` has _source, _n and _weight, the weights adding up to one. Block j of a source
    is due at (j + phase) / weight of the pool's time, one unit for each block of the pool;
    blocks follow each other by that, so each source keeps its share of every prefix. The
    phase, from 0 to 1 by the hash of the source, keeps equal sources apart. At any time the
    pool is less than a block for each of its sources away from its time.
    """

    def __init__(self, sources: DataFrame):
        phase = F.pmod(F.xxhash64(F.lit("phase"), "_source"), F.lit(1 << 20)) / (1 << 20)
        self.sources = sources.withColumn("_phase", phase)
        ends = self.sources.agg(F.max((F.col("_n") - 1 + F.col("_phase")) / F.col("_weight")), F.count(F.lit(1)))
        end, self.count = ends.first()
        # Blocks until every document had one; rounding must not leave the last one out.
        self.needed = self.sources.agg(F.sum(self._blocks(end * (1 + 1e-12) + 1e-6))).first()[0]

    def _blocks(self, time: float):
        """Blocks of a source that are due up to a time."""
        return F.floor(F.lit(float(time)) * F.col("_weight") - F.col("_phase") + 1).cast("long")

    def places(self, blocks: int) -> DataFrame:
        """_of, _nth, _at: the sources and blocks at the places from 0 to ``blocks`` and some more."""
        time = blocks + self.count + 1
        rows = self.sources.withColumn("_made", self._blocks(time)).where("_made > 0")
        rows = rows.withColumn("_nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_made") - 1)))
        rows = rows.withColumn("_due", (F.col("_nth") + F.col("_phase")) / F.col("_weight"))
        rows = rows.withColumn("_part", F.floor(F.col("_due") / max(1024, -(-time // POOL_PARTS))).cast("long"))
        rows = rows.select(F.col("_source").alias("_of"), "_n", "_nth", "_due", "_part")
        sizes = rows.groupBy(F.col("_part").alias("_in")).agg(F.count(F.lit(1)).alias("_rows"))
        before = Window.orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)  # over POOL_PARTS rows
        starts = sizes.select("_in", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
        inside = F.row_number().over(Window.partitionBy("_part").orderBy("_due", "_of", "_nth")) - 1
        ranked = rows.withColumn("_inside", inside).join(F.broadcast(starts), F.col("_part") == F.col("_in"))
        return ranked.select("_of", "_n", "_nth", (F.col("_start") + F.col("_inside")).alias("_at"))


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    temperature: float = TEMPERATURE,
    frame: int = FRAME,
) -> DataFrame:
    """Interleave documents so that each prefix has the target share of every source.

    ``weights`` maps sources to target weights; without it a source of n documents weighs
    n ** temperature. Sources that are not in it, or too small for half a slot of a frame,
    and those without any name in it, are pooled as one with their weights summed; inside
    the pool each keeps its share (``Pool``), by size where weights are given. A row of the
    pool has the release and deadline of the pool's block. Null is a source like any other.
    Given weights are held however small they are, so a large source of small weight makes the
    mix long; one below ``LEAST_WEIGHT`` of their sum is an error.

    The schedule runs until every document had a slot. Sources that end earlier start over,
    in a later epoch, so the result has every document at least once and holds the weights
    all the way. Adds slot, epoch, release and deadline to all columns, in place of any of
    that name; an empty table gives an empty result, and repeated rows are documents of
    their own.
    """
    spark = docs.sparkSession
    docs = docs.drop(*PLACES)
    named = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))
    # Columns travel as one, so that none is taken for a column of the steps below.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole.alias("_row"), named.alias("_source"), F.xxhash64(whole).alias("_order"))
    counts = stored(rows.groupBy("_source").agg(F.count(F.lit(1)).alias("_n")), "sources")
    if weights is not None:
        listed = [f"={k}" for k, w in weights.items() if w > 0]
        pool = ~F.col("_source").isin(listed)
    else:
        # At most 2 * frame sources have a share this large, so that many rows at most are read here.
        pool = F.col("_n") * (2 * frame) < F.lit(counts.agg(F.sum("_n")).first()[0] or 0)
    own = F.pow("_n", F.lit(float(temperature if weights is None else 1)))
    counts = counts.withColumn("_pool", pool).withColumn("_weight", own)
    group = F.when(F.col("_pool"), "*").otherwise(F.col("_source")).alias("_group")
    groups = counts.groupBy(group).agg(F.sum("_n").alias("_n"), F.sum("_weight").alias("_weight")).collect()
    sizes = {r["_group"]: r["_n"] for r in groups}
    summed = {r["_group"]: r["_weight"] for r in groups}
    if not sizes:
        return docs.limit(0).select("*", *[F.lit(None).cast("long").alias(c) for c in PLACES])
    if weights is None:
        target = summed
    else:
        target = {f"={k}": w for k, w in weights.items() if w > 0 and f"={k}" in sizes}
        if "*" in sizes:
            target["*"] = max(1.0 - sum(weights.values()), min(weights.values(), default=1.0))
    target = {k: target[k] for k in sizes if k in target}
    if weights is not None:
        least = sum(target.values()) * LEAST_WEIGHT
        if low := sorted(k for k, w in target.items() if w < least):
            raise ValueError(f"weights below {LEAST_WEIGHT} of their sum: {low}")
    shares = whole_shares(target, UNITS)
    frame = max(frame, len(shares))
    # The block that ends last is in a frame between the last release and the last deadline.
    last = {k: sizes[k] - 1 for k in shares}
    if "*" in shares:
        inner = counts.where("_pool").withColumn("_weight", F.col("_weight") / summed["*"])
        pooled = Pool(inner.select("_source", "_n", "_weight"))
        last["*"] = pooled.needed - 1
    low = max(last[k] * UNITS // s for k, s in shares.items()) // frame
    high = max(-(-(last[k] + 1) * UNITS // s) for k, s in shares.items())
    plan = frame_schedule(shares, low * frame, -(-high // frame) * frame)
    until = 1 + max(slot for name, block, slot, _, _ in plan if block == last[name])

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                part = frame_schedule(shares, number * frame, (number + 1) * frame)
                names, blocks, at, release, due = (list(c) for c in zip(*part, strict=True))
                columns = [pa.array(names, pa.string())]
                columns += [pa.array(c, pa.int64()) for c in (blocks, at, release, due)]
                yield pa.RecordBatch.from_arrays(columns, ["_name", "_block", "slot", "release", "deadline"])

    schema = "_name string, _block long, slot long, release long, deadline long"
    table = spark.range(-(-until // frame)).mapInArrow(slots, schema).where(F.col("slot") < until)
    windows = ["slot", "release", "deadline"]
    facts = spark.createDataFrame([(k, sizes[k]) for k in shares if k != "*"], "_of string, _n long")
    blocks = table.join(F.broadcast(facts), F.col("_name") == F.col("_of"))
    blocks = blocks.select("_of", "_n", F.col("_block").alias("_nth"), *windows)
    if "*" in shares:
        places = pooled.places(-(-until * shares["*"] // UNITS))
        inside = table.where("_name = '*'").join(places, F.col("_block") == F.col("_at"))
        blocks = blocks.unionByName(inside.select("_of", "_n", "_nth", *windows))
    epoch = F.expr("_nth div _n").alias("epoch")
    blocks = blocks.select("_of", F.expr("_nth % _n").alias("_place"), epoch, *windows)
    ranked = with_rank(rows, "_source", ["_order", "_row.doc_id"], "_rank")
    # A document has a row of the table for each epoch; a small source's are split at run time.
    placed = ranked.join(blocks, (F.col("_source") == F.col("_of")) & (F.col("_rank") == F.col("_place")))
    return placed.select("_row.*", *PLACES)
