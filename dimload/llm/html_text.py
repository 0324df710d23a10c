"""Main text of web pages: the contiguous region with the highest sum of scores.

A page is a line of words and tags. Weights are learned from pages that mark their
main element: the log odds of a token inside it against outside. A word's score is the
sum of those of three things that need no list of names: whether it stands in a link, which
block it stands in, and how many words that block has. Tags score below zero. One pass
finds the contiguous region with the largest sum. Names of menus, adverts and the like
add a fourth weight, below zero, and their words are left out of the region.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimload.llm.common import share_below, utf8

#: About so many pages that mark their main element are learned from.
SAMPLE_PAGES = 2_000

# Names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math select object noframes xmp".split())
#: Raw text that runs to the end of the page if nothing ends it; of others only the tag is passed over.
ENDLESS = frozenset("script style textarea title".split())
#: In these a slash before the bracket ends the element.
FOREIGN = frozenset(["svg", "math"])
MAIN = frozenset(["article", "main"])
BOILERPLATE = frozenset("nav header footer aside form menu dialog button".split())
#: A stray end tag of an inline element doesn't close what is around these.
AROUND = MAIN | BOILERPLATE
#: Of a form that is the page's layout, these are left out; controls hold no text or are raw.
CONTROLS = frozenset(["label", "legend"])
#: Without an end tag of their own these may hold the rest of the page.
SWALLOWING = frozenset("nav header aside menu dialog button".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that an opening one of the same kind, or of a kind beside it, closes.
CLOSED_BY = {
    "li": frozenset(["li"]),
    "p": BLOCKS,
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
}
#: Words of class, id or role that name what is not the article.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
    "contentinfo cookie cookies copyright disqus footer gdpr masthead menu modal nav navbar navigation newsletter "
    "notice notices popup pager pagination promo promoted promotion related reply replies search share sharing "
    "sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Beside these, a hint tells of the page's layout, not of the element.
LAYOUT = frozenset("has with without no wrapper layout page".split())

#: A quote opens a value only after an equals sign; elsewhere it is a character like others.
_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?>[^>\"'=]+|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))|[=\"'])*)(?:>|\Z)",
    re.S,
)
_HINTING = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[a-z]+")

#: A token: its kind, its number of words (0 for a tag), the words, whether a block begins
#: at it, whether it stands in a main element; of words, the features beside the kind: whether
#: in a link, the block around and the number of words in the block.
Token = tuple[str, int, str, bool, bool, tuple[str, ...]]


def _hinted(rest: str, in_main: bool) -> bool:
    for groups in _HINTING.findall(rest):
        for name in "".join(groups).lower().split():
            parts = _PARTS.findall(name)
            if HINTS.isdisjoint(parts) and (in_main or "header" not in parts):
                continue
            if LAYOUT.isdisjoint(parts):
                return True
    return False


def _ends(page: str, name: str) -> dict[int, int]:
    """Where the end tag stands of each element ``name`` that has one, by where it begins."""
    found, open_ = {}, []
    passed_over = r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1|\Z)"
    for match in re.finditer(rf"{passed_over}|<(?P<close>/?){name}(?=[\s/>])(?P<rest>[^>]*)", page, re.S | re.I | re.A):
        if match["close"] and open_:
            found[open_.pop()] = match.start()
        elif match["close"] == "" and not (name in FOREIGN and match["rest"].endswith("/")):
            open_.append(match.start())
    return found


def tokens(page: str) -> list[Token]:
    """The page as tokens.

    Kinds: ``word:plain``, ``word:link`` (in a link) and ``word:boilerplate``, and
    ``tag:<name>``. Raw text of scripts and the like is left out. A form, or a menu or the
    like without an end tag, is no boilerplate if it holds a main element or most of the
    page's words: of such a form labels and buttons are."""
    line, layout = _walk(page, frozenset())
    return _sized(_walk(page, layout)[0] if layout else line)


def _sized(line: list[Token]) -> list[Token]:
    """The tokens with the size of their block, in powers of two, as a feature of the words."""
    out, first, words = [], 0, 0
    for i in range(len(line) + 1):
        if i == len(line) or line[i][3]:
            size = f"size:{min(words.bit_length(), LARGEST)}"
            out += [(*t[:5], (*t[5], size)) if t[1] else t for t in line[first:i]]
            first, words = i, 0
        if i < len(line):
            words += line[i][1]
    return out


#: Blocks of 2 ** (LARGEST - 1) words and more have one weight.
LARGEST = 7


@dataclass
class Boilerplate:
    """An element of ``BOILERPLATE``, the one around it (-1: none), and the page's words before it."""

    name: str
    parent: int
    before: int
    words: int = 0
    closed: bool = False
    holds_main: bool = False


def _layout(found: list[Boilerplate], words: int) -> frozenset[int]:
    """Those of ``found`` that the page's text stands in; ``words``: all of the page."""
    loose = [e.name == "form" or e.name in SWALLOWING and not e.closed for e in found]
    out = {i for i, e in enumerate(found) if loose[i] and 2 * e.words > words}
    around: set[int] = set()
    for i, e in enumerate(found):
        while e.holds_main and i >= 0 and loose[i] and i not in around:
            around.add(i)
            i = found[i].parent
    return frozenset(out | around)


@dataclass
class Open:
    """An open element: whether it is in boilerplate, in a main element, in a hinted one and in a
    form that is layout; its own number or that of the one of ``BOILERPLATE`` around it; the
    name of the block it is in."""

    name: str
    boilerplate: bool = False
    main: bool = False
    hinted: bool = False
    in_form: bool = False
    number: int = -1
    counted: bool = False
    block: str = ""


def _walk(page: str, layout: frozenset[int]) -> tuple[list[Token], frozenset[int]]:
    """The tokens, where ``layout`` are the numbers of elements that are no boilerplate;
    and the numbers of those that shouldn't be."""
    root = Open("")
    stack, line, found = [root], [], []
    # How many elements of a name are open, and how many of them since the last one that a
    # stray end tag doesn't close: so only end tags of open elements look for them.
    open_, since = Counter(), [Counter()]
    links = at = words = 0

    def text(raw: str) -> None:
        nonlocal words
        unescaped, top = html.unescape(raw), stack[-1]
        n = len(unescaped.split())
        words += n
        kind = "word:boilerplate" if top.boilerplate else "word:link" if links else "word:plain"
        line.append((kind, n, unescaped, False, top.main, ("word:link" if links else "word:plain", f"block:{top.block}")))

    def enter(element: Open) -> None:
        stack.append(element)
        if element.name in AROUND:
            since.append(Counter())
        open_[element.name] += 1
        since[-1][element.name] += 1

    def drop() -> None:
        name = stack.pop().name
        open_[name] -= 1
        since[-1][name] -= 1
        if name in AROUND:
            since.pop()

    def leave(first: int, closed: bool) -> None:
        for i, element in enumerate(stack[first:]):
            if element.counted:
                found[element.number].words = words - found[element.number].before
                found[element.number].closed = closed and not i
        while len(stack) > first:
            drop()

    end, lower = len(page), None
    ends: dict[str, dict[int, int]] = {}
    while at < end:
        match = _TOKEN.search(page, at)
        if match is None:
            text(page[at:])
            break
        if match.start() > at:
            text(page[at : match.start()])
        at = match.end()
        if match["name"] is None:
            continue
        name, top = match["name"].lower(), stack[-1]
        line.append((f"tag:{name}", 0, "", name in BLOCKS, top.main, ()))
        if match["close"]:
            if (open_ if name in BLOCKS else since[-1])[name]:
                i = len(stack) - 1
                while stack[i].name != name:
                    i -= 1
                links -= sum(s.name == "a" for s in stack[i:])
                leave(i, True)
        else:
            if name in RAW - ENDLESS:
                if name in FOREIGN and match["rest"].endswith("/"):
                    continue
                if name not in ends:
                    ends[name] = _ends(page, name)
                at = ends[name].get(match.start(), at)
                continue
            if name in RAW:
                lower = page.lower() if lower is None else lower
                if len(lower) != end:  # a few letters change their number when lowered
                    lower = re.sub(r"</[A-Za-z]+", lambda m: m[0].lower(), page)
                stop = lower.find(f"</{name}", at)
                at = end if stop < 0 else stop
                continue
            if name in VOID or match["rest"].endswith("/") and name not in BLOCKS and name != "a":
                continue
            while name in CLOSED_BY.get(stack[-1].name, ()):
                drop()
            # What is named after something else than the article holds none of it, a main element included.
            top = stack[-1]
            hinted = name not in ("html", "body", "main") and _hinted(match["rest"], top.main or name in MAIN)
            # A header in the article is its own.
            counted = name in BOILERPLATE and not (name == "header" and top.main)
            if name in MAIN and top.number >= 0 and not (hinted or top.hinted or top.main):
                found[top.number].holds_main = True
            if counted:
                found.append(Boilerplate(name, top.number, words))
            number = len(found) - 1 if counted else top.number
            in_form = top.in_form or counted and name == "form" and number in layout
            plain = not (counted and number not in layout or in_form and name in CONTROLS)
            boiler = top.boilerplate or hinted or not plain
            main = top.main or name in MAIN and not boiler
            block = name if name in BLOCKS else top.block
            enter(Open(name, boiler, main, top.hinted or hinted, in_form, number, counted, block))
            links += name == "a"
    leave(1, False)
    return line, _layout(found, words)


#: What a page counts in all, inside its main element and outside.
PAGE = 1_000_000


def kind_counts(page: str) -> tuple[Counter, Counter]:
    """The share of each kind of token and feature of words in the main element, and outside,
    in parts of ``PAGE``: so a long page counts as a short one. What the main element holds
    of adverts and the like is outside."""
    counts = Counter(), Counter()
    for kind, words, _, _, main, features in tokens(page):
        found = counts[not main or kind == "word:boilerplate"]
        if kind[0] == "t":
            found[kind] += 1
        for feature in features if words else ():
            found[feature] += words
        if kind == "word:boilerplate":
            found[kind] += words
    inside, outside = (Counter({k: round(PAGE * n / _size(c, "word:", "tag:")) for k, n in c.items()}) for c in counts)
    return +inside, +outside


def _size(counts: dict[str, int], *groups: str) -> int:
    """How many tokens of these groups there are; boilerplate is a feature of words, counted as such."""
    return sum(n for k, n in counts.items() if k.startswith(groups) and k != "word:boilerplate")


#: Weights where no page marks its main element; boilerplate's is added to that of the word.
DEFAULT = {"word:plain": 1.0, "word:link": 0.1, "word:boilerplate": -2.0, "tag:": -0.5}
#: Words of a main element score this at least, links and all; what is left out there, and
#: tags, cost next to nothing, so a long advert doesn't part the article.
MARKED, PASSED_OVER = 1.0, -0.001


def weights_from(inside: dict[str, int], outside: dict[str, int], added: int = 1) -> dict[str, float]:
    """Log odds of inside against outside, with ``added`` to each count. Words and tags
    are shares of all tokens, the other features shares of words. Tags have a weight below
    zero (-0.05 at most), boilerplate too (-0.5); ``tag:`` is that of tags never seen."""
    out = dict(DEFAULT)
    n_in, n_out = (_size(c, "word:", "tag:") + added for c in (inside, outside))
    words_in, words_out = (_size(c, "word:") + added for c in (inside, outside))
    for kind in set(inside) | set(outside):
        token = kind.startswith("tag:") or kind in ("word:plain", "word:link")
        a, b = (n_in, n_out) if token else (words_in, words_out)
        odds = math.log((inside.get(kind, 0) + added) / a) - math.log((outside.get(kind, 0) + added) / b)
        out[kind] = min(-0.05, odds) if kind.startswith("tag:") else odds
    out["word:boilerplate"] = min(out["word:boilerplate"], -0.5)
    return out


def score(token: Token, weights: dict[str, float], share: float = 0.0) -> float:
    """``share``: of the page's words, how many stand in main elements. So far the page's own
    marks are believed: a word outside counts for the text by ``1 - share``, against it by ``share``."""
    kind, words, _, _, main, features = token
    if kind[0] == "t":
        return PASSED_OVER if main else weights.get(kind, weights["tag:"])
    if not words:
        return 0.0
    value = sum(weights.get(f, 0.0) for f in features)
    if kind == "word:boilerplate":
        # It is left out of the text, so it never speaks for a region.
        return words * (PASSED_OVER if main else min(PASSED_OVER, value + weights[kind]))
    if main:
        return words * max(MARKED, value)
    return words * (value * (1 - 2 * share) if value > 0 else value)


def extract(page: str, weights: dict[str, float]) -> str:
    """The blocks of the best region, white space as one space, one block a line."""
    line = tokens(page)
    words = [(t[1], t[4]) for t in line if t[0] in ("word:plain", "word:link")]
    share = sum(n for n, main in words if main) / max(1, sum(n for n, _ in words))
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    for i, token in enumerate(line):
        total += score(token, weights, share)
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, best_at = total, (start, i + 1)
    blocks, block = [], []
    for kind, _, text, breaks, *_ in line[slice(*best_at)]:
        if breaks:
            blocks.append(block)
            block = []
        elif kind[0] == "t":
            if kind == "tag:br":
                block.append(" ")
        elif kind != "word:boilerplate":
            block.append(text)
    blocks.append(block)
    joined = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(b for b in joined if b)


def train(pages: DataFrame, html_column: str = "html", sample_pages: int = SAMPLE_PAGES) -> dict[str, float]:
    """Weights from a bounded sample (about ``sample_pages``, chosen by hash) of the distinct pages
    that mark their main element with ``article`` or ``main``. The driver gets one row
    per kind of token, tags of HTML and no others."""
    marked = pages.where(F.col(html_column).rlike(r"(?i)<(article|main)[\s>]")).select(F.col(html_column).alias("html"))
    n = marked.select(F.xxhash64("html")).distinct().count()
    if not n:
        return dict(DEFAULT)
    known = sorted(BLOCKS | VOID | RAW | MAIN | BOILERPLATE | frozenset("a abbr b cite code em i label q s small span strong sub sup u".split()))

    @F.pandas_udf("array<struct<kind: string, inside: long, outside: long>>")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = []
            for page in batch:
                a, b = kind_counts((page or b"").decode("utf-8", "replace"))
                found.append([(k, a[k], b[k]) for k in a.keys() | b.keys()])
            yield pd.Series(found)

    sample = marked.where(share_below(F.xxhash64("html"), min(1.0, sample_pages / n)))
    sample = sample.withColumn("key", F.xxhash64("html")).dropDuplicates(["key"])
    rows = sample.select(F.explode(count(utf8("html"))).alias("t")).select("t.*")
    rows = rows.where(F.col("kind").isin([f"tag:{x}" for x in known]) | ~F.col("kind").startswith("tag:"))
    totals = rows.groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()
    # A tenth of a page: a kind found on a few pages alone decides little, one on all of them does.
    return weights_from({r.kind: r.inside for r in totals}, {r.kind: r.outside for r in totals}, PAGE // 10)


def main_text(pages: DataFrame, weights: dict[str, float], html_column: str = "html", into: str = "text") -> DataFrame:
    """Adds ``into``: the page's main text, empty if there is none or the page is NULL or empty.

    Whole pages are read; menus, headers, footers, sidebars, notices, adverts, forms,
    scripts, styles, markup and reader comments are left out wherever they stand.
    Character references are decoded, white space inside a block becomes one space,
    blocks are joined by one line feed. Other columns pass; one named ``into`` is
    replaced. Repeated rows get a text each."""

    @F.pandas_udf("string")
    def main(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([extract((page or b"").decode("utf-8", "replace"), weights) for page in batch], dtype=object)

    return pages.withColumn(into, main(utf8(html_column)))
