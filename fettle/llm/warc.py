"""WARC archives of pages, with a two-level capture index over them.

Writing: every page is a record of its own, compressed by itself, so that it can be read
alone. Of records with equal payloads one is a response and the others revisit it.

Index: a line for each capture, sorted by its key, the URL with its host reversed. Lines are
put together to compressed blocks in the files of the index; the directory keeps only the
first and last key of each block and where it lies. Blocks belong to shards, ranges of keys.

Reading: a key is searched by halving in the bounds of the shards, then in the directory of
its shard; the blocks that can hold it are read as ranges of the index files, and the records
that their lines name as ranges of the archives, in the order they lie there.

Files are written by tasks under names of their own to the folder all executors share. A file
counts only if the written table of its task names it, so what a lost or repeated task left
behind is never read.
"""

from __future__ import annotations

import bisect
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fettle.llm.common import stored
from fettle.plans.session import work_path

# Equal payloads below this size are all kept.
REVISIT_BYTES = 100
ARCHIVE_BYTES = 256_000_000
BLOCK_LINES = 1000
SHARD_LINES = 100_000
# Neighbouring records are read together up to this size.
READ_BYTES = 4_000_000
SCAN_ROWS = 500

# Names and forms of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

ENTRIES = "key string, row long, file string, offset long, length long"
DIRECTORY = "shard int, first string, last string, lines long, file string, offset long, length long"
LINES = "key string, file string, offset long, length long"
RECORDS = (
    "record_id string, page_id long, uri string, record_type string, refers_record string, "
    "stated_digest string, payload binary"
)


def url_key(url: Column) -> Column:
    """Sort key of a URL: host reversed, port, path and query; no scheme, user or fragment.

    Captures of a host, then of a domain, lie together. A text that is no URL is its own key;
    a null URL has the empty key.
    """
    form = r"^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(:[0-9]*)?([^#]*)"
    host, port, path = (F.regexp_extract(url, form, i) for i in (1, 2, 3))
    turned = F.array_join(F.reverse(F.split(F.lower(host), r"\.")), ",")
    key = F.concat(turned, port, F.lit(")"), F.when(path == "", "/").otherwise(path))
    return F.coalesce(F.when(url.rlike(form), key).otherwise(url), F.lit(""))


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _zipped(raw: bytes) -> bytes:
    """A gzip member."""
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return f"{VERSION}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def record_id(run: str, name: int | str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.UUID(run), str(name))}>"


def capture(run: str, date: str, row: dict) -> bytes:
    """The record of a page: its payload, or the name of the record that has it."""
    refers = row["refers_row"]
    payload = row["html"] if refers is None else b""
    fields = [
        ("WARC-Type", "response" if refers is None else "revisit"),
        ("WARC-Record-ID", record_id(run, row["row"])),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if row["url"] is None else quote(row["url"], safe=":/?#[]@!$&'()*+,;=%-._~")),
        ("WARC-Payload-Digest", f"sha256:{row['digest']}"),
        ("WARC-Refers-To", None if refers is None else record_id(run, refers)),
        ("WARC-Profile", None if refers is None else PROFILE),
        ("Page-ID", None if row["page_id"] is None else str(row["page_id"])),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return _record(fields, (HTTP % len(row["html"])).encode() + payload)


def parse_record(raw: bytes) -> dict:
    """A record's fields by lower-case name, with ``block``."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no record: {version[:40]!r}")
    fields: dict = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    size = int(fields["content-length"])
    if len(rest) < size:
        raise ValueError("a record is cut off")
    return fields | {"block": rest[:size]}


def with_first_copies(captures: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Add ``refers_row``: the first capture with the same payload, null for that one itself.

    First is the smallest page_id, pages without one last, then the smallest row. Groups are
    counted before the payloads move; only groups of several captures are joined back.
    """
    facts = captures.where(F.col("bytes") >= revisit_bytes).select("digest", "page_id", "row")
    groups = facts.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_page"))
    groups = groups.where("n > 1").select(F.col("digest").alias("of"), "first_page")
    first = facts.join(groups, F.col("digest") == F.col("of")).where(F.col("page_id").eqNullSafe(F.col("first_page")))
    # Written, so that its size is known where the join is planned.
    first = stored(first.groupBy("of").agg(F.min("row").alias("first_row")), "first_copies")
    same = (F.col("digest") == F.col("of")) & (F.col("bytes") >= revisit_bytes)
    refers = F.when(F.col("first_row") != F.col("row"), F.col("first_row"))
    return captures.join(first, same, "left").withColumn("refers_row", refers).drop("of", "first_row")


def write_archives(
    pages: DataFrame, folder: str, date: str, revisit_bytes: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write a record for each page to archives in ``folder``; returns where each one lies."""
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    captures = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html)
    captures = captures.select(
        "*",
        F.monotonically_increasing_id().alias("row"),
        F.sha2("html", 256).alias("digest"),
        F.octet_length("html").cast("long").alias("bytes"),
    )
    captures = stored(captures, "captures")
    run = str(uuid.uuid4())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        out, file, at = None, "", 0
        for batch in batches:
            for first in range(0, batch.num_rows, SCAN_ROWS):
                found = []
                for row in batch.slice(first, SCAN_ROWS).to_pylist():
                    if out is None:
                        file = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                        out, at = store.open_output_stream(f"{root}/{file}", compression=None), 0
                        about = f"software: fettle\r\nformat: {VERSION}\r\n".encode()
                        fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(run, file)), ("WARC-Date", date)]
                        info = _zipped(_record([*fields, ("Content-Type", "application/warc-fields")], about))
                        out.write(info)
                        at += len(info)
                    raw = _zipped(capture(run, date, row))
                    out.write(raw)
                    found.append({"key": row["key"], "row": row["row"], "file": file, "offset": at, "length": len(raw)})
                    at += len(raw)
                    if at >= archive_bytes:
                        out.close()
                        out = None
                yield pa.RecordBatch.from_pylist(found, schema)
        if out is not None:
            out.close()

    whole, text = pa.int64(), pa.string()
    schema = pa.schema([("key", text), ("row", whole), ("file", text), ("offset", whole), ("length", whole)])
    rows = with_first_copies(captures, revisit_bytes)
    rows = rows.select("row", "page_id", "url", F.col("html").cast("binary"), "digest", "refers_row", url_key(F.col("url")).alias("key"))
    return stored(rows.mapInArrow(write, ENTRIES), "entries")


def write_index(entries: DataFrame, folder: str, block_lines: int = BLOCK_LINES, shard_lines: int = SHARD_LINES) -> DataFrame:
    """Sort the lines of all captures to compressed blocks; returns the directory of blocks."""
    least = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(least, -(-entries.count() // shard_lines))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        shard, file, out, at = TaskContext.get().partitionId(), f"index-{uuid.uuid4().hex}.gz", None, 0
        lines: list[dict] = []

        def block() -> pa.RecordBatch:
            nonlocal at, lines
            raw = _zipped("\n".join(json.dumps(line) for line in lines).encode())
            out.write(raw)
            row = {"shard": shard, "first": lines[0]["key"], "last": lines[-1]["key"], "lines": len(lines), "file": file}
            row |= {"offset": at, "length": len(raw)}
            at, lines = at + len(raw), []
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for line in batch.to_pylist():
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(f"{root}/{file}", compression=None)
                lines.append(line)
                if len(lines) == block_lines:
                    yield block()
        if lines:
            yield block()
        if out is not None:
            out.close()

    whole, text = pa.int64(), pa.string()
    schema = pa.schema(
        [("shard", pa.int32()), ("first", text), ("last", text), ("lines", whole), ("file", text), ("offset", whole), ("length", whole)]
    )
    ordered = entries.repartitionByRange(shards, "key", "row").sortWithinPartitions("key", "row")
    lines = ordered.select("key", "file", "offset", "length")
    return stored(lines.mapInArrow(write, DIRECTORY), "directory")


def blocks_of(firsts: list[str], lasts: list[str], key: str) -> range:
    """Places of the ranges that can hold a key, among ranges in order that may touch."""
    return range(bisect.bisect_left(lasts, key), bisect.bisect_right(firsts, key))


def find_captures(directory: DataFrame, keys: DataFrame, folder: str) -> DataFrame:
    """Lines (key, file, offset, length) of all captures of the keys (column ``key``).

    The driver sees the bounds of the shards, a stated number of key pairs, not of blocks.
    A key of many captures, and so of many blocks and shards, is one row for each shard.
    """
    bounds = directory.groupBy("shard").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    bounds = sorted((r["first"], r["last"], r["shard"]) for r in bounds.collect())
    firsts, lasts, shards = ([b[i] for b in bounds] for i in range(3))

    def to_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(shards[i], key) for key in batch.column(0).to_pylist() for i in blocks_of(firsts, lasts, key)]
            parts = [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.string())]
            yield pa.RecordBatch.from_arrays(parts, ["shard", "key"])

    def read(asked: pa.Table, blocks: pa.Table) -> pa.Table:
        store, root = _open(folder)
        rows = sorted(blocks.to_pylist(), key=lambda b: b["offset"])
        first, last = [b["first"] for b in rows], [b["last"] for b in rows]
        wanted: dict[int, set[str]] = {}
        for key in asked["key"].to_pylist():
            for i in blocks_of(first, last, key):
                wanted.setdefault(i, set()).add(key)
        found: list[dict] = []
        files: dict[str, pa.NativeFile] = {}
        for i in sorted(wanted):
            b = rows[i]
            if b["file"] not in files:
                files[b["file"]] = store.open_input_file(f"{root}/{b['file']}")
            text = zlib.decompress(files[b["file"]].read_at(b["length"], b["offset"]), 31).decode()
            found += [line for line in map(json.loads, text.split("\n")) if line["key"] in wanted[i]]
        for file in files.values():
            file.close()
        return pa.Table.from_pylist(found, schema)

    schema = pa.schema([("key", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
    asked = keys.select("key").distinct().mapInArrow(to_shards, "shard int, key string")
    return asked.groupBy("shard").cogroup(directory.groupBy("shard")).applyInArrow(read, LINES)


def read_records(lines: DataFrame, folder: str, read_bytes: int = READ_BYTES) -> DataFrame:
    """The records that lines (file, offset, length) name, with their payloads.

    Null columns: page_id, uri and refers_record where a record has none, payload of a revisit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        name, file = "", None
        for batch in batches:
            rows = batch.to_pylist()
            at = 0
            while at < len(rows):
                first, end = rows[at], at + 1
                size = first["length"]
                while end < len(rows) and rows[end]["file"] == first["file"] and size < read_bytes:
                    if rows[end]["offset"] != first["offset"] + size:
                        break
                    size += rows[end]["length"]
                    end += 1
                if first["file"] != name:
                    if file is not None:
                        file.close()
                    name, file = first["file"], store.open_input_file(f"{root}/{first['file']}")
                raw = file.read_at(size, first["offset"])
                found = []
                for row in rows[at:end]:
                    start = row["offset"] - first["offset"]
                    fields = parse_record(zlib.decompress(raw[start : start + row["length"]], 31))
                    head, _, payload = fields["block"].partition(b"\r\n\r\n")
                    page = fields.get("page-id")
                    revisit = fields["warc-type"] == "revisit"
                    found.append(
                        {
                            "record_id": fields["warc-record-id"],
                            "page_id": None if page is None else int(page),
                            "uri": fields.get("warc-target-uri"),
                            "record_type": fields["warc-type"],
                            "refers_record": fields.get("warc-refers-to"),
                            "stated_digest": fields["warc-payload-digest"].removeprefix("sha256:"),
                            "payload": None if revisit else payload,
                        }
                    )
                yield pa.RecordBatch.from_pylist(found, schema)
                at = end
        if file is not None:
            file.close()

    text = pa.string()
    schema = pa.schema(
        [("record_id", text), ("page_id", pa.int64()), ("uri", text), ("record_type", text), ("refers_record", text)]
        + [("stated_digest", text), ("payload", pa.binary())]
    )
    least = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = lines.repartitionByRange(least, "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.select("file", "offset", "length").mapInArrow(run, RECORDS)


def archived_pages(pages: DataFrame, date: str = "2000-01-01T00:00:00Z", revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Archive all pages (page_id, url, html), look every URL up and read its records back.

    Returns for each row page_id, payload_bytes and payload_digest of the payload as read (a
    revisit's is that of the record it refers to), record_type, and refers_to, the page_id of
    the response a revisit refers to.

    A null html is an empty payload. Equal payloads of ``revisit_bytes`` and more are one
    response, that of the smallest page_id, and revisits. Rows without a page_id come last
    among equal ones, and have none when read back; repeated rows are records of their own.
    A null URL, and a text that is none, have a key like any other. Other columns are not
    read, and an empty table gives an empty result.
    """
    folder = work_path(pages.sparkSession, "archives")
    entries = write_archives(pages, folder, date, revisit_bytes)
    directory = write_index(entries, folder)
    keys = pages.select(url_key(F.col("url").cast("string")).alias("key"))
    records = read_records(find_captures(directory, keys, folder), folder)
    facts = records.select(
        "record_id",
        "page_id",
        "record_type",
        "refers_record",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
    )
    facts = stored(facts, "records")
    whole = facts.where("record_type = 'response'")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    own = whole.select(*columns, F.lit(None).cast("long").alias("refers_to"))
    source = whole.select(
        F.col("record_id").alias("refers_record"), F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest"
    )
    again = facts.where("record_type = 'revisit'").select("page_id", "record_type", "refers_record").join(source, "refers_record")
    return own.unionByName(again.select(*columns, "refers_to"))
