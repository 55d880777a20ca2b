import gzip
import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fettle.llm import warc
from fettle.plans.session import work_path

SCHEMA = "page_id long, url string, html string, `row` string, digest string, key string"
DATE = "2000-01-01T00:00:00Z"


def rows_of(pages):
    return [(i, u, h, "r", "d", "k") for i, u, h in pages]


def brute(pages, least=100):
    """page_id, bytes, digest, type and target of each row; of equal rows only one is a response."""
    first, out = {}, Counter()
    for i, _, html in pages:
        raw = (html or "").encode()
        if len(raw) >= least:
            first.setdefault(raw, []).append(i)
    first = {raw: sorted(ids, key=lambda i: (i is None, i)) for raw, ids in first.items()}
    for raw, ids in first.items():
        digest = hashlib.sha256(raw).hexdigest()
        out[ids[0], len(raw), digest, "response", None] += 1
        out.update((i, len(raw), digest, "revisit", ids[0]) for i in ids[1:])
    for i, _, html in pages:
        raw = (html or "").encode()
        if len(raw) < least:
            out[i, len(raw), hashlib.sha256(raw).hexdigest(), "response", None] += 1
    return out


def check(spark, pages, parts=3):
    df = spark.createDataFrame(rows_of(pages), SCHEMA).repartition(parts)
    assert Counter(map(tuple, warc.archived_pages(df).collect())) == brute(pages)


AWKWARD = [
    (1, "http://a.example.org/x", "<p>" + "copy " * 40),
    (7, "http://a.example.org/x", "<p>" + "copy " * 40),
    (0, "https://b.example.org:8080/y?z#f", "<p>" + "copy " * 40),
    (None, "http://a.example.org/x", "<p>" + "copy " * 40),
    (None, None, "<p>" + "copy " * 40),
    (2, None, None),
    (3, "", ""),
    (4, "no url at all\r\nHost: x", "short"),
    (5, "http://é.example/ü  \x00", "short"),
    (6, "http://C.EXAMPLE.org", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 5),
    (8, "http://c.example.org/", "x" * 99),
    (9, "http://c.example.org/", "x" * 99),
    (10, "http://c.example.org/", "x" * 100),
    (11, "http://c.example.org/", "é" * 50),
    (12, "http://d.example.org/", "é" * 50),
    (13, "http://long.example.org/", "日本 " * 400_000),
    (14, "http://long.example.org/", "日本 " * 400_000),
    (15, "http://e.example.org/", "only one null id " * 20),
    (None, "http://f.example.org/", "no id at all " * 20),
    (None, "http://f.example.org/", "no id at all " * 20),
]
AWKWARD += [AWKWARD[0], AWKWARD[0], AWKWARD[4], AWKWARD[17], AWKWARD[5]]  # repeated


@pytest.mark.parametrize("parts", [1, 5])
def test_awkward_rows(spark, parts):
    check(spark, AWKWARD, parts)


def test_hot_host_and_payload(spark):
    """A third of the rows are one page at one URL, another third one host."""
    rng = random.Random(1)
    pages = []
    for i in range(900):
        if i % 3 == 0:
            pages.append((i, "http://hot.example.org/", "<p>the hot page, with its hundred bytes and more of text, again and again</p>" * 2))
        else:
            host = "hot" if i % 3 == 1 else f"h{rng.randrange(50)}"
            pages.append((i, f"http://{host}.example.org/{rng.randrange(300)}", f"<p>{rng.randrange(200)}</p>" * 30))
    check(spark, pages, 8)


def test_empty(spark):
    assert warc.archived_pages(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize(
    "url, key",
    [
        ("http://www.Example.ORG/a/B?c=D#e", "org,example,www)/a/B?c=D"),
        ("https://u:p@x.example.org:8080", "org,example,x:8080)/"),
        ("//x.org?q", "org,x)?q"),
        ("mailto:x", "mailto:x"),
        ("", ""),
        (None, ""),
    ],
)
def test_url_key(spark, url, key):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(warc.url_key(F.col("url"))).first()[0] == key


def test_blocks_of():
    firsts, lasts = ["a", "c", "c", "c", "f"], ["c", "c", "c", "e", "g"]
    want = {"": [], "a": [0], "b": [0], "c": [0, 1, 2, 3], "d": [3], "e": [3], "ee": [], "f": [4], "h": []}
    assert {k: list(warc.blocks_of(firsts, lasts, k)) for k in want} == want


def test_files_are_archives(spark, tmp_path):
    """Whole files read as gzip hold one record after the other; entries name each of them."""
    folder = str(tmp_path / "archive")
    pages = spark.createDataFrame(rows_of(AWKWARD), SCHEMA).repartition(2)
    entries = warc.write_archives(pages, folder, DATE, archive_bytes=500).collect()
    assert len(entries) == len(AWKWARD) and len({e.file for e in entries}) > 3
    for name in {e.file for e in entries}:
        raw = (tmp_path / "archive" / name).read_bytes()
        text, kinds = gzip.decompress(raw), []
        while text:
            fields = warc.parse_record(text)
            end = text.index(b"\r\n\r\n") + 4 + int(fields["content-length"])
            assert text[end : end + 4] == b"\r\n\r\n"
            kinds.append(fields["warc-type"])
            text = text[end + 4 :]
        assert kinds[0] == "warcinfo" and len(kinds) == 1 + sum(e.file == name for e in entries)
        for e in entries:
            if e.file == name:
                gzip.decompress(raw[e.offset : e.offset + e.length])


def test_lookup_reads_only_what_is_asked(spark):
    """Small blocks: a few keys touch a few blocks, and all captures of a key come."""
    pages = [(i, f"http://h{i % 7}.example.org/{i % 40}", f"page {i} " * 20) for i in range(600)]
    df = spark.createDataFrame(rows_of(pages), SCHEMA).repartition(4)
    folder = work_path(spark, "archives")
    entries = warc.write_archives(df, folder, DATE)
    directory = warc.write_index(entries, folder, block_lines=5, shard_lines=50)
    blocks = sorted(directory.collect(), key=lambda b: (b["first"], b["shard"], b["offset"]))
    assert sum(b["lines"] for b in blocks) == 600 and max(b["lines"] for b in blocks) == 5
    wanted = {"org,example,h3)/3", "org,example,h0)/0", "org,none)/", ""}
    keys = spark.createDataFrame([(k,) for k in wanted for _ in range(3)], "key string")
    lines = warc.find_captures(directory, keys, folder)
    records = warc.read_records(lines, folder).collect()
    want = sorted(i for i, u, _ in pages if u in ("http://h3.example.org/3", "http://h0.example.org/0"))
    assert sorted(r["page_id"] for r in records) == want
    assert all(r["payload"] == (f"page {r['page_id']} " * 20).encode() for r in records)
    assert all(hashlib.sha256(r["payload"]).hexdigest() == r["stated_digest"] for r in records)
    # A destroyed block outside the answer is not read.
    held = {(b["file"], b["offset"]) for b in blocks if any(b["first"] <= k <= b["last"] for k in wanted)}
    assert 0 < len(held) < len(blocks) / 4
    path = folder.removeprefix("file://").removeprefix("file:")
    for b in blocks:
        if (b["file"], b["offset"]) not in held:
            with open(f"{path}/{b['file']}", "r+b") as file:
                file.seek(b["offset"])
                file.write(b"\0" * b["length"])
    assert warc.find_captures(directory, keys, folder).count() == len(want)


def test_broken_record_is_no_silence():
    raw = warc.capture("00000000-0000-0000-0000-000000000000", DATE, {"row": 1, "url": None, "html": b"x", "digest": "d", "refers_row": None, "page_id": 1})
    assert warc.parse_record(raw)["warc-type"] == "response"
    with pytest.raises(ValueError):
        warc.parse_record(raw[:-6])
    with pytest.raises(ValueError):
        warc.parse_record(b"HTTP/1.1 200 OK\r\n\r\n")
