"""Main text of web pages by tree scoring.

Every paragraph gives points for its length and its commas, less its part of link text, to
the elements around it: all to the nearest, half to the next, and ever less further up. The
element with the most points, less its own part of link text, is the article; siblings that
look like more of it are kept with it.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements by their role in a page.
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe", "noscript"}
VOID = "area base br col embed hr img input link meta param source track wbr".split()
NEVER = (
    "head nav footer aside form button select option template svg math object canvas audio video dialog menu "
    "datalist fieldset legend label"
).split()
BLOCKS = (
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul menu dialog search caption"
).split()
PARAGRAPHS = "p pre td th blockquote li dd dt h1 h2 h3 h4 h5 h6 figcaption".split()
HEADINGS = "h1 h2 h3 h4 h5 h6".split()
# An opening tag of the first kind ends an open one of the second, up to the third.
ENDS_P = (
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul"
).split()
IMPLIED = {
    "li": (["li"], ["ul", "ol", "menu"]),
    "dt": (["dt", "dd"], ["dl"]),
    "dd": (["dt", "dd"], ["dl"]),
    "tr": (["tr", "td", "th"], ["table"]),
    "td": (["td", "th"], ["tr", "table"]),
    "th": (["td", "th"], ["tr", "table"]),
    "option": (["option"], ["select"]),
}
# Words in a class or id, and roles, of what is no article.
BOILERPLATE = set(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner "
    "sidebar rail comment comments commentlist respond disqus cookie cookies consent gdpr notice notification "
    "alert popup modal overlay newsletter subscribe subscription signup paywall menu nav navbar navigation "
    "breadcrumb breadcrumbs footer header masthead topbar share sharing social related recommended recommendations "
    "widget widgets toolbar pagination pager login search skip skiplink copyright".split()
)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "form", "menu"}
ARTICLE = {"article", "main"}
WHOLE = {"html", "body", *ARTICLE}

# A tag whose quotes do not end, up to the end of the page, ends with its first ">".
TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)|</?([a-zA-Z][^\s/>]*+)"
    r"((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+(?:>|\Z)|[^>]*+(?:>|\Z))",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NO_DISPLAY = re.compile(r"display\s*:\s*none", re.IGNORECASE)
# Words of a name end at other characters, at digits and where the case changes.
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
SPACE = re.compile(r"\s+")

LEAST_SCORED = 25
SIBLING_PART = 0.2
# Points go this many elements up; the last gets a hundredth of them.
LEVELS = 34
MENU_LINKS = 0.6
SCHEMA = "page_id long, url string, text string"


def attributes(text: str) -> dict[str, str]:
    """Values by lower-case name; of several with one name the first counts."""
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return found


def name_words(value: str) -> set[str]:
    return {w.lower() for w in WORDS.findall(value)}


def unwanted(tag: str, found: dict[str, str], inside: bool) -> bool:
    """Whether an element is no article, by its tag, names, role or that it is not shown."""
    if tag in NEVER or tag == "header" and not inside:
        return True
    if tag in WHOLE or not found:
        return False
    if "hidden" in found or found.get("aria-hidden", "").strip().lower() == "true":
        return True
    if NO_DISPLAY.search(found.get("style", "")) or ROLES & set(found.get("role", "").lower().split()):
        return True
    words = name_words(found.get("class", "")) | name_words(found.get("id", ""))
    return bool(words & BOILERPLATE - ({"header"} if inside else set()))


class Page:
    """Elements as rows (tag, parent, dropped, ...) and blocks as (element, text, link characters).

    Parents come before their children. What holds for an element and all in it is carried
    down when it is opened, so a page takes time in proportion to its length.
    """

    def __init__(self, html: str):
        self.tags, self.parents, self.dropped = ["#root"], [-1], [False]
        # The nearest block around an element, and whether it is in an article.
        self.holder, self.inside = [0], [False]
        self.blocks: list[tuple[int, str, int]] = []
        self.open = [0]
        # Places of the open elements of each tag.
        self.places: dict[str, list[int]] = defaultdict(list)
        self.text: list[str] = []
        self.linked: list[str] = []
        self.breaks = 0
        at = 0
        while m := TOKEN.search(html, at):
            self.data(html[at : m.start()])
            at = m.end()
            if not m[1]:
                continue
            tag = m[1].lower()
            if m[0][1] == "/":
                self.close(tag)
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
                at = end.end() if end else len(html)
                continue
            self.start(tag, m[2])
        self.data(html[at:])
        self.flush()

    def data(self, raw: str) -> None:
        if raw:
            self.text.append(text := unescape(raw))
            if not text.isspace():
                self.breaks = 0
            if self.places["a"]:
                self.linked.append(text)

    def flush(self) -> None:
        """End a block: the text since the last border of a block element."""
        if text := SPACE.sub(" ", "".join(self.text)).strip():
            if not self.dropped[self.open[-1]]:
                linked = len(SPACE.sub(" ", "".join(self.linked)).strip())
                self.blocks.append((self.holder[self.open[-1]], text, linked))
        self.text, self.linked, self.breaks = [], [], 0

    def pop_to(self, place: int) -> None:
        gone = self.open[place:]
        if any(self.tags[n] in BLOCKS for n in gone):
            self.flush()
        for n in gone:
            self.places[self.tags[n]].pop()
        del self.open[place:]

    def find(self, tags: list[str], until: list[str]) -> int | None:
        """Place of the innermost open element with one of the tags, inside any of the others."""
        place = max((p[-1] for t in tags if (p := self.places.get(t))), default=-1)
        border = max((p[-1] for t in until if (p := self.places.get(t))), default=-1)
        return place if place >= max(border, 0) else None

    def start(self, tag: str, text: str) -> None:
        if tag == "br":
            self.breaks += 1
            if self.breaks > 1:
                self.flush()
            self.text.append(" ")
            return
        if tag in BLOCKS:
            self.flush()
        if tag in ENDS_P and (place := self.find(["p"], ["td", "th", "li", "div", "section", "article", "table"])):
            self.pop_to(place)
        ends, until = IMPLIED.get(tag, ([], []))
        while ends and (place := self.find(ends, until)):
            self.pop_to(place)
        if tag in VOID:
            return
        above, node = self.open[-1], len(self.tags)
        drop = self.dropped[above] or unwanted(tag, attributes(text), self.inside[above])
        if drop and not self.dropped[above]:
            self.flush()
        self.tags.append(tag)
        self.parents.append(above)
        self.dropped.append(drop)
        self.holder.append(node if tag in BLOCKS else self.holder[above])
        self.inside.append(self.inside[above] or tag in ARTICLE)
        self.places[tag].append(len(self.open))
        self.open.append(node)

    def close(self, tag: str) -> None:
        if tag == "p" and self.find(["p"], []) is None:
            self.flush()
        if tag == "br":
            self.text.append(" ")
        place = self.find([tag], ["td", "th", "table"] if tag not in BLOCKS else [])
        if place is not None:
            if self.dropped[self.open[place]] and not self.dropped[self.open[place - 1]]:
                self.flush()
            self.pop_to(place)

    def article(self) -> list[str]:
        """Texts of the blocks of the article, in page order."""
        every = range(len(self.tags))
        size, linked = [0] * len(self.tags), [0] * len(self.tags)
        score, links = [0.0] * len(self.tags), [0] * len(self.tags)
        for node, text, in_links in self.blocks:
            size[node] += len(text)
            linked[node] += in_links
            links[node] += in_links > 0
            if len(text) < LEAST_SCORED:
                continue
            points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - in_links / len(text))
            n = self.parents[node] if self.tags[node] in PARAGRAPHS else node
            level = 0
            while level < LEVELS and (n > 0 or level == 0):
                score[max(n, 0)] += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
                n, level = self.parents[n] if n > 0 else 0, level + 1
        for n in reversed(every[1:]):
            size[self.parents[n]] += size[n]
            linked[self.parents[n]] += linked[n]
            links[self.parents[n]] += links[n]
        for n in every:
            if size[n]:
                score[n] *= (1 - linked[n] / size[n]) * (1.5 if self.tags[n] in ARTICLE else 1)
        best = max(every, key=lambda n: (score[n], -n))
        if score[best] <= 0:  # nothing long enough to score
            named = [n for n in every if self.tags[n] in ARTICLE and size[n] > linked[n]]
            best = named[0] if named else 0
        kept, menu = [False] * len(self.tags), [False] * len(self.tags)
        for n in every:
            above = self.parents[n]
            kept[n] = n == best or n > 0 and (kept[above] or self.sibling(n, best, size, linked, score))
            is_list = self.tags[n] in ("ul", "ol", "dl", "table")
            menu[n] = is_list and links[n] > 2 and linked[n] > MENU_LINKS * size[n] or n > 0 and menu[above]
        return [text for node, text, _ in self.blocks if kept[node] and not menu[node]]

    def sibling(self, n: int, best: int, size: list[int], linked: list[int], score: list[float]) -> bool:
        """Whether an element beside the best one is more of the article."""
        if self.parents[n] != self.parents[best] or not size[n]:
            return False
        light = linked[n] / size[n] < 0.25
        kept_p = self.tags[n] in PARAGRAPHS and light and size[n] > 80
        heading = self.tags[n] in HEADINGS and light and n < best
        return light and score[n] >= max(10, SIBLING_PART * score[best]) or kept_p or heading


def main_text(html: str | None) -> str:
    """Blocks of the article joined by an empty line; empty if there is none."""
    return "\n\n".join(Page(html).article()) if html else ""


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url and the main text of every row, from its whole html, without a shuffle.

    A null or empty html, and one without text, give an empty text. Repeated rows stay as
    they are; other columns are not read. Broken markup never fails: open elements end with
    the page, and a tag, comment or script that never ends takes the rest of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = pa.array([main_text(h) for h in part.column(2).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), texts], ["page_id", "url", "text"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(run, SCHEMA)
