"""The rules once more in plain Python, for small inputs."""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict

ACCEPT = {"UQAM", "U Q A M", "UNIVERSITE DU QUEBEC A MONTREAL"}
REVIEW = {"AQAM", "QAM", "COOP UQAM"}


def normal(text: str) -> str:
    flat = unicodedata.normalize("NFKD", text.strip().upper())
    flat = "".join(c for c in flat if not unicodedata.combining(c))
    return " ".join(re.sub("[^A-Z0-9]", " ", flat).split())


def collapsed(text: str) -> str:
    text = text.strip()
    parts = [p.strip() for p in re.split(r"[|/]", text) if p.strip()]
    return parts[0] if len(parts) > 1 and len({normal(p) for p in parts}) == 1 else text


def common(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def percent(a: str, b: str) -> float:
    return 200.0 * common(a, b) / (len(a) + len(b))


def best_window(short: str, long: str) -> float:
    n, m = len(short), len(long)
    cuts = [long[max(i, 0) : i + n] for i in range(1 - n, m)]
    return max(percent(short, c) for c in cuts if c)


def score(a: str, b: str) -> int:
    a, b = normal(a).replace(" ", ""), normal(b).replace(" ", "")
    if not a or not b:
        return 0
    if len(a) == len(b):
        partial = max(best_window(a, b), best_window(b, a))
    else:
        partial = best_window(*sorted((a, b), key=len))
    return round((percent(a, b) + partial) / 2)


def is_review(text: str) -> bool:
    n = normal(collapsed(text))
    short = n.replace(" ", "")
    return bool(n) and (n in REVIEW or (len(short) <= 12 and "QAM" in short and n not in ACCEPT))


def variants(names: list[str]) -> dict[str, tuple[str, int, str]]:
    """Suggestion, score and decision per admitted name; ``names`` is in source order."""
    counts: dict[str, int] = defaultdict(int)
    for n in names:
        counts[n] += 1
    groups = defaultdict(list)
    for n in counts:
        groups[normal(collapsed(n)).replace(" ", "")].append(n)
    out = {}
    for n in counts:
        form = normal(collapsed(n))
        members = groups[form.replace(" ", "")]
        if not form:
            continue
        if form in ACCEPT:
            out[n] = ("UQAM", 100, "accepted")
            continue
        if len(members) > 1:
            if any(normal(collapsed(m)) in ACCEPT for m in members):
                label = "UQAM"
            else:
                label = min(members, key=lambda m: (-counts[m], len(normal(m)), normal(m)))
        elif is_review(n):
            label = "UQAM"
        else:
            continue
        s = score(n, label)
        out[n] = (label, s, "accepted" if s >= 95 else "review" if s >= 80 else "rejected")
    return out


def sections(text: str, n: int) -> list[tuple[int, int, str]]:
    found = []
    for number, part in enumerate(re.split(r"(?=^#{1,3}\s)", text, flags=re.MULTILINE), start=1):
        part = part.strip()
        for k, start in enumerate(range(0, len(part), n), start=1):
            found.append((number, k, part[start : start + n]))
    return found


def bounded(texts: list[str], budget: int) -> str:
    used, kept = 0, []
    for t in texts:
        left = budget - used
        if left <= 0:
            break
        kept.append(t[:left])
        used += len(kept[-1]) + 2
    return "\n\n".join(kept)
