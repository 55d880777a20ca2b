import hashlib
import math
import re
from collections import Counter

from helpers import awkward, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from fettle.llm import queries, secrets

PATTERNS = [
    ("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
    ("access", r"AKIA[A-Z0-9]+"),
    ("hex", r"[0-9a-f]+"),
]


def brute(text):
    out = []
    for n, (kind, p) in enumerate(PATTERNS):
        for m in re.finditer(p, text, re.I | re.A if n == 0 else 0):
            least = len(m[2]) >= 6 if n == 0 else len(m[0]) >= (20 if n == 1 else 24)
            if least:
                out.append((m.start(), n, kind, m.end()))
    return [(kind, s, e) for s, _, kind, e in sorted(out)]


@settings(max_examples=500, deadline=None)
@given(
    st.lists(
        st.sampled_from(["token", "SECRET", "ſecret", "api_key", "=", ":", " ", "'", "AKIA", "0a1b2c3d4e5f", "ABCDEF0123456789", "xyz", "é", "\n"]),
        max_size=12,
    ).map("".join)
)
def test_base_spans(text):
    assert [s for s in secrets.find(text) if s[0] != "entropy"] == brute(text)


def entropy(part):
    return -sum(n / len(part) * math.log2(n / len(part)) for n in Counter(part).values())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB3dE6fGhIjK9+/_", min_size=20, max_size=60))
def test_windows_equal_entropy_from_scratch(token):
    if any(a.fullmatch(token) for a in secrets.ALLOWED):
        assert secrets.random_spans(token) == []
        return
    least = next(t for _, c, t in secrets.CLASSES if c.fullmatch(token))
    hit = set()
    for i in range(len(token) - 19):
        part = token[i : i + 20]
        mixed = any(c.isdigit() for c in part) and not part.isdigit()
        if mixed and entropy(part) >= least + 1e-9:
            hit.update(range(i, i + 20))
    found = {p for s, e in secrets.random_spans(token) for p in range(s, e)}
    assert hit <= found
    close = {p for s, e in secrets.random_spans(token) for p in range(s, e)} - hit
    assert not close or any(abs(entropy(token[i : i + 20]) - least) < 1e-6 for i in range(len(token) - 19))


def test_entropy_and_allowed():
    random_key = "wJalrXUtnFEMI7K8MDENG3bPxRfiCYz"
    assert [s[0] for s in secrets.find(f"see {random_key} here")] == ["entropy"]
    for clean in (
        "pneumonoultramicroscopicsilicovolcanoconiosis",
        "123e4567-e89b-12d3-a456-426614174000",
        "path/to/some/ordinary/file/name",
        "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz1",
        "AbstractSingletonProxyFactoryBean2",
    ):
        assert secrets.find(clean) == []
    assert [s[0] for s in secrets.find("password=" + random_key)] == ["assign"]


def test_random_string_beside_a_fixed_pattern():
    """Only what the pattern covers is cut out of the candidate."""
    key = "wJalrXUtnFEMI7K8MDENG3bPxRfiCYz9kQ2sTvLp"
    access, run = "AKIA" + "Q7" * 8, "0a1b2c3d4e5f" * 3
    for text in (f"{access}/{key}", f"{access}={key} x", f"{key}/{access}", f"{key}-{run}-{key}"):
        found = secrets.find(text)
        base = [s for s in found if s[0] != "entropy"]
        held = {p for _, s, e in base for p in range(s, e)}
        spans = [(s, e) for k, s, e in found if k == "entropy"]
        assert spans and all(not held & set(range(s, e)) for s, e in spans)
        assert sum(key in text[s : e + 1] or text[s:e].strip("/=-") in key for s, e in spans) == text.count(key)
    assert [s[0] for s in secrets.find("password=" + key)] == ["assign"]
    assert [s[0] for s in secrets.find(f"{access}/short")] == ["access"]


def test_time_with_many_spans():
    import time

    text = ("AKIA" + "Q7" * 8 + "/") * 5_000 + " token=abcdef1234" * 5_000
    text += " token=abcdef1234 QmxK7zP2vR9sT4wY6nB1cD3" * 20_000
    start = time.process_time()
    assert len(secrets.find(text)) >= 10_000
    assert time.process_time() - start < 15


def test_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in queries.documents(spark, sf_dir).collect()}
    rows = queries.op8_secret_scan(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[0] == k for s in base) for k, _ in PATTERNS)
        assert set(joined.split(",")) - {""} <= set(r["spans"].split(","))


def test_awkward_rows(spark):
    assert secrets.scan_secrets(awkward(spark)).count() == awkward(spark).count()
    assert secrets.scan_secrets(empty(spark)).count() == 0
