import re
import time
from html import unescape

import pytest
from helpers import words
from hypothesis import given, settings
from hypothesis import strategies as st

from fettle.llm import queries
from fettle.llm.html import HEADINGS, PARAGRAPHS, Page, extract_text, main_text

PARA = "A sentence of the article, with commas, and with enough words to be taken for prose, I think. "

PAGE = f"""<!doctype html><html><head><title>T</title><style>p {{ }}</style></head><body class="has-sidebar">
<header><h1>Site name</h1><p>{PARA}</p></header><nav><ul><li><a href=/>Home, sweet, home</a></ul></nav>
<div class="cookie-notice"><p>{PARA * 3}</p></div>
<div id=main><h1>Title &amp; more</h1><div class="entry">
<p>First {PARA}<p>Second <a href=x>link</a>, {PARA}
<ul><li>one, {PARA}</li><li>two</li></ul>
<script>var a = "<p>no, no, no</p>";</script><form><p>Sign up, {PARA * 4}</p></form>
<p>Third<br>{PARA}</div>
<ul><li><a href=1>Related one</a><li><a href=2>Related two</a><li><a href=3>Related three</a></ul></div>
<section id="comments"><p>Nice, {PARA * 5}</p></section>
<aside><p>Aside, {PARA * 2}</p></aside><footer><p>Footer, {PARA * 2}</p></footer></body></html>"""


def test_article_alone():
    p = PARA.strip()
    assert main_text(PAGE).split("\n\n") == [
        "Title & more", f"First {p}", f"Second link, {p}", f"one, {p}", "two", f"Third {p}"]


def test_pages(spark, sf_dir):
    """In the test pages the article is marked; only white space may differ."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op4_html_extraction(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|<footer|$)", pages[r["page_id"]], re.DOTALL)[1]
        plain = unescape(re.sub(r"<[^>]*(>|$)", " ", inner)).split()
        assert r["text"].split() == plain and r["n_chars"] == len(r["text"])


def test_small_and_broken_pages():
    assert main_text(None) == main_text("") == main_text("<p></p>") == main_text("<script>x") == ""
    assert main_text("a<b") == "a" and main_text("<p>x &amp") == "x &" and main_text("<!-- open") == ""
    assert main_text("<article><p>Short.</article>") == "Short."
    assert main_text("<p>a\n\t b&nbsp;c</p><div>d<br><br>e<br>f</div>") == "a b c\n\nd\n\ne f"
    assert main_text("</p></div><p>x") == "x"


def test_very_long_and_deep_pages():
    text = words(1, 200_000)
    assert main_text(f"<div><p>{text}</p></div>") == text
    assert main_text("<div>" * 3000 + f"<p>{PARA}") == PARA.strip()


def test_rows(spark):
    rows = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, PAGE, None), (3, None, "", "")]
    out = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert sorted(r["text"] for r in out.collect()) == ["", "", "", main_text(PAGE)]
    assert extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<td>", "<li>", "<br>", "text, ", "<a href='", "'", "<", ">", "&", "<!--", "-->", "<script>", "</script>", "<header>", "</b>", "<table>"]), max_size=30).map("".join))
def test_never_fails(html):
    assert isinstance(main_text(html), str)


ARTICLE = f"<article><p>{PARA * 4}</p>%s</article>"


@pytest.mark.parametrize(
    "part, kept",
    [
        (f'<div title="a hidden gem"><p>{PARA}</p></div>', True),
        (f'<div data-id="share"><p>{PARA}</p></div>', True),
        (f'<div data-hidden="x" alt="display:none"><p>{PARA}</p></div>', True),
        (f'<div hidden><p>{PARA}</p></div>', False),
        (f"<div HIDDEN='until-found'><p>{PARA}</p></div>", False),
        (f'<div aria-hidden="true"><p>{PARA}</p></div>', False),
        (f'<div aria-hidden="false"><p>{PARA}</p></div>', True),
        (f'<div style="color: red; display : none"><p>{PARA}</p></div>', False),
        (f'<div class="commentSection"><p>{PARA}</p></div>', False),
        (f'<div class="comments2"><p>{PARA}</p></div>', False),
        (f'<div id=XMLComment><p>{PARA}</p></div>', False),
        (f'<div class="commentary shareholder adverbial"><p>{PARA}</p></div>', True),
        (f'<div class="a" class="comments"><p>{PARA}</p></div>', True),
        (f'<div role="Complementary"><p>{PARA}</p></div>', False),
    ],
)
def test_attributes_by_exact_name(part, kept):
    text = main_text(ARTICLE % part)
    assert text == "\n\n".join([(PARA * 4).strip()] + [PARA.strip()] * kept)


def test_links_under_other_marks_are_menus():
    marked = "<li><a href=x><b><i><u><s><em>words of a menu, to somewhere</em></s></u></i></b></a></li>"
    assert main_text(f"<div><p>{PARA * 4}</p><ul>{marked * 6}</ul></div>") == (PARA * 4).strip()


@pytest.mark.parametrize("tag", ['<a title="x>', "<a title='x>", '<a title="x" alt=">'])
def test_quotes_that_do_not_end(tag):
    assert main_text(f"<p>before {tag}text</a> after</p>") == "before text after"


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 50_000 + f"<p>{PARA}",
        "<span>" * 50_000 + "x<br><br>" * 500 + "</b>" * 50_000,
        "<table><b>" + "<i>" * 30_000 + "</b>" * 30_000,
        "<ul><li>" * 25_000 + "x",
        '<a title="' * 30_000,
        "<p " * 50_000,
        "<!--" * 50_000,
        f"<p>{PARA}</p>" * 5_000,
    ],
)
def test_time_in_proportion_to_length(page):
    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 4


def plain_article(page):
    """The same scores by walking from every block to the root, and back for every element."""
    n = len(page.tags)

    def up(node):
        return [node, *up_from(node)]

    def up_from(node):
        out = []
        while node > 0:
            node = page.parents[node]
            out.append(node)
        return out

    paths = [up(b[0]) for b in page.blocks]

    def total(node, value):
        return sum(value(b) for b, path in zip(page.blocks, paths) if node in path)

    size, linked = [total(i, lambda b: len(b[1])) for i in range(n)], [total(i, lambda b: b[2]) for i in range(n)]
    links = [total(i, lambda b: b[2] > 0) for i in range(n)]
    score = [0.0] * n
    for node, text, in_links in page.blocks:
        if len(text) >= 25:
            points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - in_links / len(text))
            first = max(page.parents[node], 0) if page.tags[node] in PARAGRAPHS else node
            chain = [i for i in up(first) if i] or [0]
            for level, i in enumerate(chain[:34]):
                score[i] += points / {0: 1, 1: 2}.get(level, 3 * level)
    score = [s * (1 - linked[i] / size[i]) * (1.5 if page.tags[i] in ("article", "main") else 1) if size[i] else s for i, s in enumerate(score)]
    best = max(range(n), key=lambda i: (score[i], -i))
    if score[best] <= 0:
        best = next((i for i in range(n) if page.tags[i] in ("article", "main") and size[i] > linked[i]), 0)
    kept = {best}
    for i in range(1, n):
        if page.parents[i] == page.parents[best] and i != best and size[i] and linked[i] / size[i] < 0.25:
            if score[i] >= max(10, 0.2 * score[best]) or page.tags[i] in PARAGRAPHS and size[i] > 80 or page.tags[i] in HEADINGS and i < best:
                kept.add(i)
    menus = {i for i in range(n) if page.tags[i] in ("ul", "ol", "dl", "table") and links[i] > 2 and linked[i] > 0.6 * size[i]}
    return [b[1] for b, path in zip(page.blocks, paths) if kept & set(path) and not menus & set(path)]


PIECES = "<p> </p> <div> </div> <article> </article> <section> </section> <ul> </ul> <li> <table> <tr> <td> </table> <h2> </h2> <span> </span> <a> </a>".split()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*PIECES, PARA, PARA * 3, "short, words", "<a href=x>" + PARA + "</a>"]), max_size=60).map("".join))
def test_equals_plain_scores(html):
    page = Page(html)
    assert page.article() == plain_article(page)
