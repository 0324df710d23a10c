import re
import time

import pytest
from pyspark.sql import functions as F

from dimload.llm import html_text

LONG = "Words of the article that go on for a while and then some more."


def page(body, head="<title>T</title><style>p{x:y}</style><script>var t=\"</p>\";</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About us all</a></li></ul></nav>'
CASES = {
    "article": (page(f"{NAV}<article><h1>Head</h1><p>{LONG}</p><p>Two<br>lines &amp; more</p></article><footer>&copy; us</footer>"), f"Head\n{LONG}\nTwo lines & more"),
    "unclosed": (f'<html><body>{NAV}<div class="ad">Buy this now</div><article><h1>Head</h1><p><b>{LONG}<br><p>x &lt; y &am', f"Head\n{LONG}\nx < y &am"),
    "inside": (
        page(
            f'<article><h1>Head</h1><p>{LONG}</p><aside>Related things to read</aside><div class="cookie-notice">We use cookies</div>'
            f'<form><input><label>Mail</label></form><!-- <p>no</p> --><p>{LONG}</p><section id="comments"><p>First! {LONG}</p></section></article>'
        ),
        f"Head\n{LONG}\n{LONG}",
    ),
    "header": (page(f"<header>Site name</header><main><header><h1>Head</h1></header><p>{LONG}</p></main>"), f"Head\n{LONG}"),
    "layout": (page(f'<div class="has-sidebar"><article><p>{LONG}</p></article><div class="sidebar">Links</div></div>'), LONG),
    "space": (page(f"<article><p> a\n\t b&nbsp;c </p><p>\n</p><p>{LONG}</p></article>"), f"a b c\n{LONG}"),
    "plain": (page(f"{NAV}<div><p>{LONG}</p><p>{LONG}</p></div><footer>Imprint and more</footer>"), f"{LONG}\n{LONG}"),
    "inline": (page("<article><p>un<b>bel</b>ievable <i>x</i>y</p></article>"), "unbelievable xy"),
    "attribute": (page(f"<article><p title=\"a > b\" class='x'>{LONG}</p></article>"), LONG),
    "parted": (page(f"<article><p>{LONG}</p><aside>{LONG * 50}</aside><p>{LONG}</p></article><p>Other</p>"), f"{LONG}\n{LONG}"),
    "short": (page(f"{NAV}<article><h1>A</h1><p>b</p><div><div><p>c</p></div></div></article><footer>x</footer>"), "A\nb\nc"),
    "none": (page(NAV), ""),
    "empty": ("", ""),
    "null": (None, ""),
    "not html": ("< 3 and a <b", "< 3 and a"),
}


@pytest.mark.parametrize("learned", [True, False])
def test_pages(spark, learned):
    rows = [(k, h) for k, (h, _) in CASES.items()] * 2 + [("long", page(f"<article>{'<p>a b</p>' * 50_000}</article>"))]
    pages = spark.createDataFrame(rows, "page_id string, html string").repartition(3)
    pages = pages.withColumn("kind", F.lit("extra")).withColumn("text", F.lit("replaced"))
    weights = html_text.train(pages) if learned else dict(html_text.DEFAULT)
    found = html_text.main_text(pages, weights)
    assert set(found.columns) == set(pages.columns)
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id == "long":
            assert r.text == "\n".join(["a b"] * 50_000)
        else:
            assert r.text == CASES[r.page_id][1], r.page_id


def test_best_region_by_brute_force():
    """The linear scan finds the largest sum over all contiguous regions."""
    weights = {"word:plain": 1.0, "tag:": -0.7, "tag:p": -0.3, "word:boilerplate": -1.0, "word:link": 0.2}
    text = "<div>a b</div><div><div><div>x</div></div></div><p>one two three<p>four<nav>m n o p</nav><p>five <a>l</a></p><div><div><div>z"
    line = list(html_text.tokens(text))
    value = [html_text.score(t, weights) for t in line]
    regions = [(i, j) for i in range(len(value)) for j in range(i, len(value) + 1)]
    best = max(sum(value[i:j]) for i, j in regions)
    region = max((r for r in regions if abs(sum(value[slice(*r)]) - best) < 1e-9), key=lambda r: r[0] - r[1])
    words = " ".join(t[2] for t in line[slice(*region)] if t[0][0] == "w" and t[0] != "word:boilerplate").split()
    assert html_text.extract(text, weights).split() == words


def test_weights():
    weights = html_text.weights_from({"word:plain": 90, "tag:p": 9}, {"word:boilerplate": 50, "tag:p": 1, "tag:a": 30})
    assert weights["word:plain"] > 0 > weights["tag:p"] > weights["tag:a"] and weights["word:boilerplate"] < 0


def test_no_rows(spark):
    pages = spark.createDataFrame([], "page_id long, html string")
    assert html_text.main_text(pages, html_text.train(pages)).count() == 0


@pytest.mark.parametrize(
    "before",
    [
        '<svg viewBox="0 0 1 1"/>',
        '<math xmlns="m" />',
        "<svg><path d='x'><p>",
        "<select><option>",
        "<object data=x>",
        "<select name=a><option>",
        "<SVG><svg><text>no</text></svg><text>no</text></SVG>",
        "<svg><!-- <svg> --><text>no</text></svg>",
    ],
)
def test_raw_elements_without_an_end(before):
    """Nothing of the page is lost behind them, nor up to the end of another of their kind."""
    body = f"<article>{before}<p>{LONG}</p><svg><text>no</text></svg><select><option>no</select><object>no</object><p>{LONG}</p></article>"
    assert html_text.extract(page(body), html_text.DEFAULT) == f"{LONG}\n{LONG}"
    assert html_text.extract(page(f"<article><p>{LONG}</p></article><script>var x = '{LONG}'"), html_text.DEFAULT) == LONG


def test_teasers_in_articles():
    """An article without a telling name that holds little of the page doesn't hide the text."""
    teasers = "<article><a href='/x'>Read this too</a></article><article><h2>More</h2></article>"
    body = f"{NAV}<div class=content><h1>The head of it all</h1>{f'<p>{LONG}</p>' * 4}</div><div>{teasers}</div>"
    for weights in (html_text.DEFAULT, html_text.weights_from({"word:plain": 90}, {"word:boilerplate": 50, "tag:div": 9})):
        assert html_text.extract(page(body), weights).startswith("\n".join(["The head of it all", *[LONG] * 4]))
    # One that holds a fair share is the text.
    assert html_text.extract(page(f"<div>{LONG}</div><article><p>{LONG}</p></article>"), html_text.DEFAULT) == LONG


@pytest.mark.parametrize(
    "body",
    [
        f"<form id=aspnetForm><input type=hidden><nav>Home</nav><article><h1>Head</h1><p>{LONG}</p></article><button>Go</button></form>",
        f"<form><main><h1>Head</h1><label>Your name</label><p>{LONG}</p></main><select><option>no</select></form>",
        f"<nav><a href=/>Home</a><article><h1>Head</h1><p>{LONG}</p></article>",
        f"<aside>x<form><article><h1>Head</h1><p>{LONG}</p></article></form>",
        f"<dialog><p>Read</p><main><h1>Head</h1><p>{LONG}</p></main>",
    ],
)
def test_main_element_in_a_form(body):
    assert html_text.extract(page(body), html_text.DEFAULT) == f"Head\n{LONG}"


def test_form_around_the_page():
    """A form with most of the page's words is layout; labels and buttons in it, and small forms, are left out."""
    body = f"<form><nav>Home and more</nav><div><p>{LONG}</p><label>Name of yours</label><button>Send it</button><p>{LONG}</p></div></form>"
    assert html_text.extract(page(body), html_text.DEFAULT) == f"{LONG}\n{LONG}"
    body = f"<div><p>{LONG}</p><p>{LONG}</p></div><form><p>{LONG}</p></form>"
    assert html_text.extract(page(body), html_text.DEFAULT) == f"{LONG}\n{LONG}"
    # Teasers in an aside, and a form that is named, stay out.
    body = f"<div><p>{LONG}</p></div><aside><article><p>{LONG}</p></article></aside><form class=search><main>{LONG}</main></form>"
    assert html_text.extract(page(body), html_text.DEFAULT) == LONG


def test_copies_are_learned_from_once(spark):
    pages = [page(f"{NAV}<article><p>{LONG} {i}</p></article><p>x {i}</p>") for i in range(8)]
    once, often = (spark.createDataFrame([(p,) for p in x], "html string") for x in (pages, pages + pages[:1] * 30))
    assert html_text.train(once) == html_text.train(often)


def test_a_quote_opens_a_value_only_after_an_equals_sign():
    weights = dict(html_text.DEFAULT)
    body = f'<article><p>{LONG} <a href="x"">more</a></p><p title=don\'t>{LONG}</p><p a="b>c" d = \'>\' e>{LONG}</p></article>'
    assert html_text.extract(page(body), weights) == f"{LONG} more\n{LONG}\n{LONG}"
    assert html_text.extract(page(f'<p class="a\'b">{LONG}</p><p x\'>{LONG}</p>'), weights) == f"{LONG}\n{LONG}"


@pytest.mark.parametrize(
    "text",
    [
        "<span>" * 30_000 + "</i>" * 10_000,
        "<i><article>" + "<span>" * 20_000 + "</i>" * 20_000,
        "<form>" * 40_000 + "<main>words",
        "<a href=" + "\"x=' " * 50_000,
        "<p " + "='" * 100_000,
    ],
)
def test_work_grows_with_the_page(text):
    began = time.process_time()
    html_text.extract(text, dict(html_text.DEFAULT))
    assert time.process_time() - began < 3


def nameless(text):
    """The page with every telling element as a ``div`` without attributes."""
    text = re.sub(r"(</?)(article|main|nav|header|footer|aside|form|section)\b", r"\1div", text)
    return re.sub(r"\s(class|id|role)=(\"[^\"]*\"|[^\s>]+)", "", text)


def test_learned_weights_find_the_text_without_names(spark):
    """Weights learned from pages that mark their article leave out menus, adverts and footers that no name tells."""
    def article(i):
        paragraphs = "".join(f"<p>{' '.join([f'w{i}x{k}'] * (20 + 3 * k))}</p>" for k in range(4))
        return f"<h1>About the number {i}</h1>{paragraphs}<p>{LONG}</p>"

    def whole(i):
        return page(f"{NAV}<div class=ad>Buy one of these now, {i} left</div><article>{article(i)}</article><footer>All rights with us, {i}</footer>")

    weights = html_text.train(spark.createDataFrame([(whole(i),) for i in range(60)], "html string"))
    for i in range(60, 80):
        marked = html_text.extract(whole(i), weights)
        assert marked.startswith(f"About the number {i}\n") and marked.endswith(LONG)
        assert html_text.extract(nameless(whole(i)), weights) == marked
    assert weights["word:link"] < 0 < weights["size:5"] and weights["block:li"] < 0 < weights["block:p"]


def test_main_elements_are_believed_by_their_share():
    """Words outside count less the more of the page main elements hold, and nothing from one half on."""
    token = ("word:plain", 5, "a b c d e", False, False, ("word:plain", "block:p"))
    scores = [html_text.score(token, html_text.DEFAULT, k / 10) for k in range(11)]
    assert scores == sorted(scores, reverse=True) and scores[0] == 5 and scores[5] == 0 and scores[10] == -5
    # A word that scores below zero anyway stays there; inside, marks only add.
    assert html_text.score(token, html_text.DEFAULT | {"word:plain": -1.0}, 1.0) == -5
    inside = (*token[:4], True, token[5])
    assert html_text.score(inside, html_text.DEFAULT | {"word:plain": -1.0}, 0.1) == 5


def test_pages_count_alike_however_long():
    """The tokens of a page add up to one page inside and outside, whatever their number."""
    counts = [html_text.kind_counts(page(f"{NAV}<article>{'<p>a b c d</p>' * n}</article>")) for n in (1, 1000)]
    for found in (c for pair in counts for c in pair):
        total = sum(n for kind, n in found.items() if kind.startswith("tag:") or kind in ("word:plain", "word:link"))
        assert abs(total - html_text.PAGE) <= len(found)
    assert counts[0][1] == counts[1][1]
