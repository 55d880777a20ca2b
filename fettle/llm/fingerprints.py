"""Document fingerprints as invertible Bloom lookup tables, in DataFrame functions only.

A document is the set of digests of its paragraphs. Each digest is added to one cell of
each of four subtables; a cell holds the number, the xor of the digests and the xor of
their checks. Subtracting the tables of two documents leaves the digests they do not share.
A cell with a single one gives it away; taking it out of its other cells lays open the next,
until the table is empty. If it does not get empty, both documents are put in a larger
table with other hashes.

The first table has a fixed size and is the fingerprint. Larger ones are peeled as rows of
cells: of each digest a subtable has one cell, so a round that peels the cells of a single
subtable finds no digest twice, and takes one aggregation by cell. All of it keeps to the
one partitioning by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fettle.llm.common import stored

TABLES = 4
BASE_CELLS = 48
# Rounds of the fixed table, and of one subtable each of larger ones.
BASE_ROUNDS = 10
ROUNDS = 20
# A paragraph is a line, or of a longer one a run of at least so many characters that ends
# with a sentence.
PARAGRAPH = 120
# Pairs go to larger tables in parts of so many paragraphs of the table at most, on average. A
# paragraph is in four cells of each table that it is in, so a part has millions of cells.
PART = 1 << 17


def digests(text: Column, least: int = PARAGRAPH) -> Column:
    """Distinct digests of the paragraphs of a text."""
    pattern = rf"[^\n]{{{least},}}?[.!?](?=\s|$)|[^\n]+"
    parts = F.filter(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda p: F.trim(p) != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(F.trim(p))))


def check(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key, F.lit("check")), 32)


def cell(key: Column, table: int, cells: Column, seed: int) -> Column:
    """Number of the digest's cell in a subtable."""
    width = (cells / TABLES).cast("long")
    return F.lit(table) * width + F.pmod(F.xxhash64(key, F.lit(seed * TABLES + table)), width)


def _changes(keys: Column, sign: int, cells: Column, seed: int) -> Column:
    """What a set of digests adds to the cells of a table."""
    return F.flatten(
        F.transform(
            keys,
            lambda k: F.array(
                *[
                    _cell_of(cell(k, t, cells, seed), F.lit(sign).cast("long"), k, check(k))
                    for t in range(TABLES)
                ]
            ),
        )
    )


def _cell_of(c: Column, n: Column, k: Column, h: Column) -> Column:
    return F.struct(c.alias("c"), n.alias("n"), k.alias("k"), h.alias("h"))


def _less(a: Column, b: Column) -> Column:
    """A cell without what another holds."""
    return _cell_of(a["c"], a["n"] - b["n"], a["k"].bitwiseXOR(b["k"]), a["h"].bitwiseXOR(b["h"]))


def _in_use(cells: Column) -> Column:
    return F.filter(cells, lambda c: (c["n"] != 0) | (c["k"] != 0))


def _peel(cells: Column, size: Column, seed: int) -> Column:
    """Number of digests in a table of cells (c, n, k, h); null if it does not get empty."""

    def turn(state: Column, _: Column) -> Column:
        pure = F.array_distinct(
            F.transform(
                F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (check(c["k"]) == c["h"])),
                lambda c: F.struct(
                    c["n"].alias("n"),
                    c["k"].alias("k"),
                    c["h"].alias("h"),
                    F.array(*[cell(c["k"], t, size, seed) for t in range(TABLES)]).alias("at"),
                ),
            )
        )

        def rest(p: Column) -> Column:
            taken = F.transform(
                state["cells"],
                lambda c: F.aggregate(F.filter(p, lambda x: F.array_contains(x["at"], c["c"])), c, _less),
            )
            return F.struct(_in_use(taken).alias("cells"), (state["found"] + F.size(p)).alias("found"), (F.size(p) > 0).alias("on"))

        # The digests of a round are worked out once and handed on as a list of one.
        after = F.element_at(F.transform(F.array(pure), rest), 1)
        return F.when(state["on"], after).otherwise(state)

    start = F.struct(cells.alias("cells"), F.lit(0).alias("found"), F.lit(True).alias("on"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(BASE_ROUNDS)), start, turn, lambda s: F.when(F.size(s["cells"]) == 0, s["found"])
    )


def _grouped(changes: Column) -> Column:
    """Cells of a list of changes, for the few tables that are made inside a row."""
    zero = F.lit(0).cast("long")
    return F.transform(
        F.array_distinct(F.transform(changes, lambda x: x["c"])),
        lambda c: F.aggregate(
            F.filter(changes, lambda x: x["c"] == c),
            _cell_of(c, zero, zero, zero),
            lambda a, x: _cell_of(a["c"], a["n"] + x["n"], a["k"].bitwiseXOR(x["k"]), a["h"].bitwiseXOR(x["h"])),
        ),
    )


def _table_text(cells: Column, size: Column) -> Column:
    """A table as text: the number of digests and the cells that are not empty."""
    parts = F.transform(
        F.filter(cells, lambda c: c["n"] != 0),
        lambda c: F.concat_ws(".", F.hex(c["c"]), F.hex(c["n"]), F.hex(c["k"]), F.hex(c["h"])),
    )
    return F.concat_ws(" ", size.cast("string"), parts)


def successors(ids: DataFrame) -> DataFrame:
    """(id, next) for distinct long ids: the next larger one, for the largest the smallest.

    Ids are looked at in blocks of 4096 values, the blocks in larger blocks and so on, so no
    window holds more than 2^18 rows whatever the ids.
    """
    first = ids.agg(F.min("id")).first()[0]
    table: DataFrame | None = None
    for bits, wider in ((47, 64), (30, 47), (12, 30)):
        blocks = ids.groupBy(F.shiftright("id", bits).alias("block")).agg(F.min("id").alias("first"))
        window = Window.orderBy("block") if wider == 64 else Window.partitionBy(F.shiftright("block", wider - bits)).orderBy("block")
        after = blocks.withColumn("after", F.lead("first").over(window))
        if table is not None:
            above = table.select(F.col("block").alias("_above"), F.col("after").alias("_later"))
            after = after.join(above, F.shiftright("block", wider - bits) == F.col("_above"))
            after = after.withColumn("after", F.coalesce("after", "_later"))
        table = after.select("block", "after")
    block = F.shiftright("id", 12)
    inside = ids.withColumn("_in", F.lead("id").over(Window.partitionBy(block).orderBy("id")))
    found = inside.join(table, block == F.col("block"))
    return found.select("id", F.coalesce("_in", "after", F.lit(first)).alias("next"))


def edited_documents(docs: DataFrame) -> DataFrame:
    """Each row with its edited text and the digests of its next document.

    Columns key and copy (of equal keys), doc_id, n_chars, text, edited, following, has_next,
    dealt by key. The next document is a row of the next larger doc_id (after the largest:
    the smallest). Rows without an id have none: nothing is put in place of what goes.
    """
    key = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    rows = docs.select(key.alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    sizes = docs.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id"))
    ids = sizes.agg(F.max(F.coalesce(F.length("text"), F.lit(0))).alias("n"))
    order = successors(ids.select("id")).join(ids.select(F.col("id").alias("_id"), "n"), F.col("id") == F.col("_id"))
    order = order.select(
        F.col("next").cast("string").alias("_next"),
        F.col("id").cast("string").alias("_prev"),
        F.floor(F.col("n") / 4).cast("int").alias("_most"),
    )
    order = stored(order, "order")
    # Both uses of the rows below read the same columns in the same way, so that all that is
    # made of them shares one shuffle of the texts. Equal rows are told apart
    # by their place among those of one key.
    same = Window.partitionBy("key").orderBy(F.xxhash64("text"))
    rows = rows.withColumn("copy", F.row_number().over(same))
    ahead = rows.where(F.abs("copy") == 1).join(order, F.col("key") == F.col("_next"))
    ahead = ahead.select("_prev", F.expr("left(text, _most)").alias("_head"), digests(F.col("text")).alias("following"))
    both = rows.join(ahead, F.col("key") == F.col("_prev"), "left")
    size = F.length("text")
    quarter = F.floor(size / 4).cast("int")
    head = F.coalesce(F.substring("_head", F.lit(1), quarter), F.lit(""))
    return both.select(
        "key",
        "copy",
        F.expr("try_cast(key as bigint)").alias("doc_id"),
        size.cast("long").alias("n_chars"),
        "text",
        F.concat(F.substring("text", F.lit(1), size - quarter), head).alias("edited"),
        F.coalesce("following", F.array().cast("array<bigint>")).alias("following"),
        F.col("_prev").isNotNull().alias("has_next"),
    )


def _parts(docs: DataFrame) -> int:
    """Number of parts of pairs: by lines and bytes, as a long line has many paragraphs."""
    size = F.octet_length("text")
    lines = size - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    most = lines + size / PARAGRAPH
    most = docs.agg(F.sum(most)).first()[0] or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, round(most / PART))


def _peel_rows(pairs: DataFrame, seed: int, parts: int = 8) -> DataFrame:
    """(key, copy, kind, found) of the pairs (key, copy, kind, one, other, cells) that get empty.

    The pairs are dealt anew, so that their cells are not in memory beside the texts. The number
    of parts is given, as a few bytes of digests become many cells. All rounds run in one task
    for each part.
    """
    cells, keys = F.col("cells"), ["key", "copy", "kind", "cells"]
    zero = F.lit(0).cast("long")
    pairs = pairs.repartition(parts, "key", "copy")
    changes = F.concat(_changes(F.col("one"), 1, cells, seed), _changes(F.col("other"), -1, cells, seed))

    def settled(rows: DataFrame) -> DataFrame:
        """Cells by number, without those that are empty; number -1 counts what a pair gave away."""
        cells = rows.groupBy(*keys, "c").agg(
            F.sum("n").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("h").alias("h"), F.sum("got").alias("got")
        )
        return cells.where("n <> 0 or k <> 0 or got > 0")

    rows = pairs.select(*keys, F.inline(changes)).withColumn("got", zero)
    rows = settled(rows)
    for t in range(ROUNDS):
        table = t % TABLES
        mine = F.floor(F.col("c") / (cells / TABLES)) == table
        pure = mine & (F.abs("n") == 1) & (check(F.col("k")) == F.col("h"))
        itself = F.struct("c", "n", "k", "h", "got")
        # A cell that gives its digest away is empty and goes. What a pair gave is counted in
        # one row, so that a table shrinks from round to round.
        given = F.struct(F.lit(-1).cast("long").alias("c"), zero.alias("n"), zero.alias("k"), zero.alias("h"), F.lit(1).cast("long").alias("got"))
        others = [
            F.struct(cell(F.col("k"), o, cells, seed).alias("c"), (-F.col("n")).alias("n"), "k", "h", zero.alias("got"))
            for o in range(TABLES)
            if o != table
        ]
        rows = settled(rows.select(*keys, F.inline(F.when(pure, F.array(given, *others)).otherwise(F.array(itself)))))
    left = F.sum(F.when((F.col("n") != 0) | (F.col("k") != 0), 1).otherwise(0))
    done = rows.groupBy("key", "copy", "kind").agg(F.sum("got").cast("int").alias("found"), left.alias("_left"))
    return done.where("_left = 0").drop("_left")


def _same_row() -> Column:
    """Join condition on key and copy that deals rows by key alone, as they already are."""
    return (F.col("key") == F.col("_key")) & (F.col("copy") <= F.col("_copy")) & (F.col("copy") >= F.col("_copy"))


def _with_base(rows: DataFrame) -> DataFrame:
    """Adds the base tables of own, changed and following, cell by cell, as ``table``."""
    names = ["own", "changed", "following"]
    size = F.lit(BASE_CELLS)
    tagged = [
        F.struct(F.lit(v).alias("v"), _changes(F.col(n), 1, size, 0).alias("cells")) for v, n in enumerate(names)
    ]
    cells = rows.select("key", "copy", F.inline(F.array(*tagged)))
    cells = cells.select("key", "copy", "v", F.inline("cells"))
    sums = []
    for v in range(len(names)):
        is_v = F.col("v") == v
        sums.append(F.count(F.when(is_v, 1)).alias(f"n{v}"))
        sums += [F.bit_xor(F.when(is_v, F.col(x)).otherwise(0)).alias(f"{x}{v}") for x in ("k", "h")]
    cells = cells.groupBy("key", "copy", "c").agg(*sums)
    parts = [f"{x}{v}" for v in range(len(names)) for x in ("n", "k", "h")]
    table = cells.groupBy(F.col("key").alias("_key"), F.col("copy").alias("_copy")).agg(
        F.sort_array(F.collect_list(F.struct("c", *parts))).alias("table")
    )
    joined = rows.join(table, _same_row(), "left")
    return joined.drop("_key", "_copy")


def _part(v: int) -> Column:
    return F.transform("table", lambda x: _cell_of(x["c"], x[f"n{v}"], x[f"k{v}"], x[f"h{v}"]))


def _difference(v: int, w: int) -> Column:
    def less(x: Column) -> Column:
        return _less(_cell_of(x["c"], x[f"n{v}"], x[f"k{v}"], x[f"h{v}"]), _cell_of(x["c"], x[f"n{w}"], x[f"k{w}"], x[f"h{w}"]))

    return F.coalesce(_in_use(F.transform("table", less)), F.array().cast("array<struct<c:bigint,n:bigint,k:bigint,h:bigint>>"))


def _retried(one: Column, other: Column) -> Column:
    """Third try inside a row, for the one in thousands that a larger table did not help.

    Should it fail too, the sets are compared as they are.
    """
    size = F.lit(TABLES) * (2 * (F.size(one) + F.size(other)) + 16)
    cells = _in_use(_grouped(F.concat(_changes(one, 1, size, 2), _changes(other, -1, size, 2))))
    plain = F.size(F.array_except(one, other)) + F.size(F.array_except(other, one))
    return F.coalesce(_peel(cells, size, 2), plain)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited text, and how alike they are.

    doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next. Alike
    is the Jaccard similarity of two sets of paragraphs: from their sizes, which the
    fingerprints carry, and the number of digests that peeling their difference recovers.
    Two texts without paragraphs are alike by 1. A null text counts as empty; equal rows get
    equal results; rows without an id have near_next 0. Only doc_id and text are read. An
    empty table gives an empty result.
    """
    rows = edited_documents(docs)
    rows = rows.withColumn("own", digests(F.col("text"))).withColumn("changed", digests(F.col("edited"))).drop("text")
    tried = _with_base(rows)
    size = F.lit(BASE_CELLS)
    tried = tried.withColumn("_edited", _peel(_difference(0, 1), size, 0)).withColumn("_next", _peel(_difference(0, 2), size, 0))

    # Larger tables with other hashes for the pairs that did not come apart: three cells for
    # each digest of the two documents, so that even a difference of everything fits.
    pair = [
        F.when(F.col(found).isNull(), F.struct(F.lit(kind).alias("kind"), F.col("own").alias("one"), F.col(other).alias("other")))
        for kind, found, other in (("edited", "_edited", "changed"), ("next", "_next", "following"))
    ]
    failed = tried.select("key", "copy", F.explode(F.filter(F.array(*pair), lambda p: p.isNotNull())).alias("p"))
    # A key of bytes keeps Spark from its small map in front of every partial aggregate: each
    # takes a page when the task starts and holds it until its round is over, and those of all
    # rounds take all the memory of the task.
    failed = failed.select(F.encode("key", "utf-8").alias("key"), "copy", "p.*")
    room = F.ceil((3 * (F.size("one") + F.size("other")) + 32) / TABLES) * TABLES
    again = _peel_rows(failed.withColumn("cells", room.cast("long")), 1, _parts(docs))
    again = again.groupBy("key", "copy").agg(
        F.max(F.when(F.col("kind") == "edited", F.col("found"))).alias("_edited2"),
        F.max(F.when(F.col("kind") == "next", F.col("found"))).alias("_next2"),
    )
    # It cannot be null: a filter for that would be pushed down to the rows, and their texts would
    # be shuffled twice.
    name = F.coalesce(F.decode("key", "utf-8"), F.lit("")).alias("_key")
    again = again.select(name, F.col("copy").alias("_copy"), "_edited2", "_next2")
    done = tried.join(again, _same_row(), "left")

    def near(found: str, other: str) -> Column:
        """Sizes a and b with d digests not shared: (a + b - d) / (a + b + d)."""
        apart = F.coalesce(F.col(f"_{found}"), F.col(f"_{found}2"), _retried(F.col("own"), F.col(other)))
        both = F.size("own") + F.size(other)
        return F.when(both == 0, F.lit(1.0)).otherwise((both - apart) / (both + apart))

    return done.select(
        "doc_id",
        "n_chars",
        "edited",
        _table_text(_part(0), F.size("own")).alias("fingerprint"),
        _table_text(_part(1), F.size("changed")).alias("edited_fingerprint"),
        near("edited", "changed").alias("near_edited"),
        F.when(F.col("has_next"), near("next", "following")).otherwise(F.lit(0.0)).alias("near_next"),
    )
