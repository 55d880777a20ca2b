"""Secret scan: fixed patterns and the entropy of sliding windows over candidate strings."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds in their order, pattern, group whose length counts, least length.
BASE = [
    (
        "assign",
        re.compile(
            r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
            re.IGNORECASE | re.ASCII,
        ),
        2,
        6,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
]
KINDS = ["assign", "access", "hex", "entropy"]

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
# Character classes, narrowest first, with the entropy in bits a character from which a
# window of WINDOW characters counts as random. A window of 20 has at most 4.32 bits.
CLASSES = [
    ("digits", re.compile(r"[0-9]+"), math.inf),
    ("hex", re.compile(r"[0-9a-fA-F]+"), 3.0),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 3.75),
]
# Strings that look random and are none: identifiers with a fixed layout, paths and words.
ALLOWED = [
    re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"),
    re.compile(r"[A-Za-z]+"),
    re.compile(r"[a-z]*(?:[A-Z][a-z]+)+[0-9]*"),
    re.compile(r"[A-Za-z]*(?:[-_/+=][A-Za-z]*)+[0-9]{0,4}"),
    re.compile(r"(?:[A-Za-z0-9_-]{0,15}/)+[A-Za-z0-9_-]{0,15}"),
]

SCHEMA = "doc_id long, kinds array<string>, starts array<int>, ends array<int>"


def random_spans(token: str, window: int = WINDOW) -> list[tuple[int, int]]:
    """Merged windows of a candidate whose entropy reaches the threshold of its class.

    The sum of n log2 n over the counts of a window is kept up to date by the character
    that comes in and the one that goes out.
    """
    if len(token) < window or any(a.fullmatch(token) for a in ALLOWED):
        return []
    least = next(t for _, c, t in CLASSES if c.fullmatch(token))
    if least == math.inf:
        return []
    terms = [0.0, *(n * math.log2(n) for n in range(1, window + 2))]
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    for i, c in enumerate(token):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += terms[n + 1] - terms[n]
        if i >= window:
            c = token[i - window]
            n = counts[c]
            counts[c] = n - 1
            total += terms[n - 1] - terms[n]
        if i >= window - 1:
            part = token[i + 1 - window : i + 1]
            mixed = any(x.isdigit() for x in part) and not part.isdigit()
            if mixed and math.log2(window) - total / window >= least:
                start = i + 1 - window
                if spans and start <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], i + 1)
                else:
                    spans.append((start, i + 1))
    return spans


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all spans, by start and then by kind as listed."""
    spans = []
    for kind, pattern, group, least in BASE:
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                spans.append((kind, m.start(), m.end()))
    taken = sorted((s, e) for _, s, e in spans)
    first = 0
    for m in CANDIDATE.finditer(text):
        if any(a.fullmatch(m[0]) for a in ALLOWED):
            continue
        while first < len(taken) and taken[first][1] <= m.start():
            first += 1
        # What fixed patterns have found is cut out; the rest is judged by itself.
        at, place = m.start(), first
        while at < m.end():
            cut = place < len(taken) and taken[place][0] < m.end()
            start, end = taken[place] if cut else (m.end(), m.end())
            if start > at:
                spans += [("entropy", at + s, at + e) for s, e in random_spans(text[at:start])]
            at, place = max(at, end), place + 1
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Spans of every text: doc_id, kinds, starts, ends (code points, end exclusive).

    One row for each row of the input, in one pass without a shuffle; a null text counts as
    empty. Columns other than doc_id and text are not read. Spans of fixed patterns are cut
    out of a candidate before its entropy is judged, so no entropy span overlaps one, and a
    random string next to one is found.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = [find(t) if t else [] for t in part.column(1).to_pylist()]
                columns = [
                    part.column(0),
                    pa.array([[s[0] for s in f] for f in found], pa.list_(pa.string())),
                    pa.array([[s[1] for s in f] for f in found], pa.list_(pa.int32())),
                    pa.array([[s[2] for s in f] for f in found], pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "kinds", "starts", "ends"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, SCHEMA)


def spans_text(kinds: list[str]):
    """kind:start:end of the spans of the given kinds, joined by commas."""
    zipped = F.arrays_zip("kinds", "starts", "ends")
    wanted = F.filter(zipped, lambda s: s["kinds"].isin(kinds))
    return F.array_join(F.transform(wanted, lambda s: F.concat_ws(":", s["kinds"], s["starts"], s["ends"])), ",")
