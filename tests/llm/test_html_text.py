"""Main text of pages, and least cuts against all labellings."""

import itertools
import random
import time

import pytest

from towerlens.llm.flow import least_cut
from towerlens.llm.html_text import blocks, extracted, main_text
from towerlens.llm.queries import op8_main_text


def test_least_cuts():
    chance = random.Random(3)
    for _ in range(1500):
        n = chance.randint(1, 7)
        excess = [chance.randint(-5, 5) for _ in range(n)]
        edges = [(chance.randrange(n), chance.randrange(n), chance.randint(0, 4)) for _ in range(chance.randint(0, 10))]

        def cost(sides):
            return sum(-e for e, side in zip(excess, sides) if side) + sum(c for a, b, c in edges if sides[a] != sides[b])

        assert cost(least_cut(excess, edges)) == min(map(cost, itertools.product([False, True], repeat=n)))
    assert least_cut([], []) == []


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var a = "<p>no</p>";</script></head><body class="post">
<header><a href=/>Site</a><p>A slogan that is long enough to be a sentence of its own.</p></header>
<nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>
<div id="cookie-notice">We use cookies and a lot of words to say so, which is not the article at all.</div>
<div class="wrap"><div id="content"><h1>Title &amp; more</h1><p>Short.<p>A long   paragraph&nbsp;with <b>bold</b>
and a <a href=x>link</a>, and a good many words besides.<br>After a break &lt;tag&gt; &#233;</p>
<!-- <p>comment</p> --><div class="ad">Buy this thing now, it is a very good thing and quite cheap today.</div>
<ul><li>first item</li><li>second item</li></ul><table><tr><td>a<td>b</table><blockquote>Quote.</blockquote></div>
<div class="sidebar"><h3>Popular</h3><p>Some long teaser text of another article that is here.</p></div></div>
<section class="comments"><article><p>A reader's long comment on the article, with many words in it.</p></article></section>
<form><label>Name</label><input value=x><button>Send</button></form><footer>&copy; x</footer>"""


def test_page():
    assert main_text(PAGE).split("\n") == [
        "Title & more", "Short.", "A long paragraph with bold and a link, and a good many words besides. After a break <tag> é",
        "first item", "second item", "a", "b", "Quote.",
    ]


def test_marks_are_read_from_attributes_only():
    page = "<div class='site-header'><p>The site's own line of text, long enough.</p></div><main><div data-id=menu title='hidden'>"
    page += "<p data-class='ad'>One paragraph of text.</p><p hidden>Not shown at all, to nobody.</p><p class=AdBox>Buy.</p></div>"
    page += "<header class=header><h1>Title</h1></header><figure><figcaption>A picture of it.</figcaption></figure></main>"
    assert main_text(page) == "One paragraph of text.\nTitle\nA picture of it."


BODY = "<h1>Title of it</h1><p>The first paragraph has quite a few words in it.</p><p>The second one has a few more words, all the same.</p><p>Third, <b>short</b>.</p><p>The fourth ends the article with some words.</p>"
LINES = ["Title of it", "The first paragraph has quite a few words in it.", "The second one has a few more words, all the same.", "Third, short.", "The fourth ends the article with some words."]
MENU = "<nav><a href=1>One</a> <a href=2>Two</a></nav>"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title><meta charset=utf-8><body>{MENU}<article>{BODY}</article></body></html>",
        f"<title>T</title>{MENU}<article>{BODY}</article>",
        f"<html><body><form id='aspnetForm' action='x'>{MENU}<article>{BODY}</article></form>",
        f"<form id='aspnetForm'>{MENU}<div>{BODY}</div></form>",
        f"<body>{MENU}<div class='content with-sidebar'>{BODY}</div><div class='sidebar'><p>Some teaser text of another article.</p></div>",
        f"<article class='post no-comments'>{BODY}</article><footer>Copyright by us, all rights reserved.</footer>",
        f"<div id='story-share-page'>{BODY}<div class='share'>Share this story with all your friends now.</div></div>",
        f"<article><svg viewBox='0 0 1 1'>{BODY}</article>",
        f"<article><video src=x>{BODY}</article>",
        f"<article><object data=x><p>Fallback text that nobody sees here.</p></object>{BODY}<svg><text>Drawn words.</text></svg></article>",
        f"<article>{BODY}</article><section class='comments'><article><p>A reader's long comment on the article, with many words in it.</p></article></section>",
        f"<main><!-- {BODY} --><a b='>' c=\">\"></a>{BODY}</main>",
    ],
)
def test_ordinary_pages(page):
    assert main_text(page).split("\n") == LINES


def test_lists_of_links_and_formulas_in_an_article():
    page = f"{MENU}<article><h1>Ten pages to read</h1><ul><li><a href=1>The first page</a></li><li><a href=2>The second page</a></li></ul>"
    page += "<p>Where <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds for all of them.</p></article>"
    assert main_text(page).split("\n") == ["Ten pages to read", "The first page", "The second page", "Where x=2 holds for all of them."]


@pytest.mark.parametrize(
    "piece", ["<a x", "<a x='", '<a x="', "<a x='>", "<a '\">", "<", "<!--", "</p", "<svg>", "<div>", "<li>", "<h1><li>", "<div></x>", "</div>", "<p>a", "<form><p>word "]
)
def test_long_odd_pages_take_little_time(piece):
    page = piece * ((1 << 20) // len(piece))
    start = time.perf_counter()
    blocks(page)
    long = time.perf_counter() - start
    assert long < 15, long
    start = time.perf_counter()
    blocks(page[: len(page) // 4])
    # In proportion to the length, give or take what runs beside the test.
    assert long < 0.5 + 12 * (time.perf_counter() - start)


def test_odd_pages(spark):
    odd = [None, "", " \n ", "<", "<p", "<!--", "<script>x", "</p></div>", "<p>" * 3000 + "x", "<div>" * 3000 + "<p>deep text here.", PAGE, PAGE]
    pages = spark.createDataFrame([(place, "u", html) for place, html in enumerate(odd)], "page_id long, text string, html string")
    rows = {r.page_id: r for r in extracted(pages, ["page_id"]).collect()}
    assert len(rows) == len(odd)
    assert [rows[place].text for place in range(6)] == [""] * 3 + [rows[3].text, "", ""]
    assert rows[10].text == main_text(PAGE) and rows[10].n_chars == len(main_text(PAGE))
    assert extracted(pages.limit(0), ["page_id"]).count() == 0


def test_articles_of_the_given_pages(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = op8_main_text(spark, sf_dir).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for row in rows:
        article = pages[row.page_id].split("<article>")[1].split("</article>")[0]
        assert row.text == main_text(f"<article>{article}")
        assert row.text and "\n".join(line.strip() for line in row.text.split("\n")) == row.text
