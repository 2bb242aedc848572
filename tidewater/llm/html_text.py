"""Main text of HTML pages from flat text blocks and a decision tree.

A page is cut into flat text blocks at block-level tags. Each block is
described by its number of words, its link density, the same two figures of the
block before and after it, whether it is a heading, and where it stands (inside an
article, inside a container named as page furniture, or neither). A
decision tree, trained here on the small labelled table ``LABELLED``, says which
blocks belong to the article. Kept blocks are joined by ``\\n`` in page order.

White space inside a block becomes one space; character references are
decoded after the markup is gone; ``<br>`` is white space.

Defined results: a null or empty page, or one without an article block, gives
the empty string. Tags left open or cut off at the end of the page are taken
as they stand; an unended comment, script or style runs to the end of the page, an
unended element of ``UNREAD`` (button, svg and the like) to the next block tag. The
head needs no end tag, and the text of formulas stays.
Pages are read one by one and whole, so ties, repeated rows and extra columns
need no care; an empty table gives an empty one.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_list

RAW = ("script", "style")
# No text of the page either; one left open ends at the next block tag.
UNREAD = ("noscript", "template", "svg", "iframe", "object", "textarea", "select", "button", "canvas", "title")
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset
    figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option
    p pre section summary table tbody tfoot thead tr ul""".split())
SPACE = frozenset(("br", "td", "th", "wbr", "img", "input"))
HEADING = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
CONTAINER = frozenset("""article aside body details dialog div dl fieldset figure footer form header main menu nav ol
    section table tr td ul p span li blockquote""".split())
FURNITURE_TAGS = frozenset(("nav", "footer", "aside", "form", "header", "menu", "dialog", "fieldset"))
# Words of class, id and role attributes that name page furniture. In a name of several words the last one
# says what it is ("main-menu" is a menu, "message-body" a body); the strong ones always count.
FURNITURE_WORDS = frozenset("""ad ads adbox advert adverts advertisement advertising alert banner breadcrumb breadcrumbs
    byline comment comments complementary consent contentinfo cookie cookies copyright disclaimer discussion disqus footer form
    gdpr header links login masthead menu message modal nav navbar navigation newsletter notice notification outbrain
    pagination pager popup promo promoted promotion recommend recommended related replies reply respond rail search share
    sharing sidebar signup site-footer skip social sponsor sponsored subscribe subscription taboola teaser toolbar topbar
    widget""".split())
STRONG_WORDS = frozenset("""ad ads adbox advert adverts advertisement advertising comment comments cookie cookies disqus nav
    navbar outbrain related replies reply respond sidebar sponsor sponsored taboola""".split())
ARTICLE_WORDS = frozenset(("article", "main", "post", "story", "entry", "content"))
LAYOUT_WORDS = frozenset("app body box column container grid inner layout outer page root row section site wrap wrapper".split())
# "has-sidebar" says what a page has, not what an element is.
MODIFIERS = frozenset("can has hide is no not show with without".split())
# What makes a form more than a form: it wraps the page.
_wraps = re.compile(r"<(?:article|main|h1)(?![a-z0-9:-])|<p(?![a-z0-9:-]).*<p(?![a-z0-9:-])", re.S | re.I)

_attrs = r"(?![a-z0-9:-])(?:[^>\"']|\"[^\"]*\"|'[^']*')*"
_markup = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + ")" + _attrs + r"(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<svg(?![a-z0-9:-])(?:[^>\"'/]|/(?!>)|\"[^\"]*\"|'[^']*')*+/>"
    r"|<(?P<unread>" + "|".join(UNREAD) + ")" + _attrs + r"(?:>(?:(?:[^<]+|<(?!/?(?P=unread)(?![a-z0-9:-])))*+</(?P=unread)\s*>"
    r"|(?:[^<]+|<(?!/?(?:" + "|".join(sorted(BLOCK - {"option", "optgroup", "hr", "legend"})) + r")(?![a-z0-9:-])))*+)|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.S | re.I)
_attribute = re.compile(r"([^\s=>\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_unseen = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_ends = {tag: re.compile(rf"</{tag}(?![a-z0-9:-])", re.I) for tag in ("form", "fieldset")}
_split = re.compile(r"[^a-z0-9]+")
_camel = re.compile(r"(?<=[a-z])(?=[A-Z])")

INSIDE, NEITHER, FURNITURE = 1, 0, -1


class Block(NamedTuple):
    text: str
    place: int
    heading: int
    words: int
    density: float


def _said(name: str, tag: str) -> int | None:
    """What one class, id or role name says; -2 for furniture that nothing outweighs."""
    words = [w for w in _split.split(_camel.sub(" ", name).lower()) if w and w != tag]
    if not words or words[0] in MODIFIERS:
        return None
    known, last = set(words), words[-1]
    if known & STRONG_WORDS or last in FURNITURE_WORDS:
        return 2 * FURNITURE
    if known & FURNITURE_WORDS:
        return None if last in LAYOUT_WORDS else FURNITURE
    return INSIDE if known & ARTICLE_WORDS else None


def _place(tag: str, attrs: str, outer: int, rest) -> int | None:
    """What a container says about its content; None: nothing. ``rest()`` is the page after the tag."""
    said: set[int | None] = set()
    if attrs:
        values = {}
        for m in _attribute.finditer(attrs):
            values.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        if "hidden" in values or values.get("aria-hidden", "").lower() == "true" or _unseen.search(values.get("style", "")):
            return FURNITURE
        said = {_said(n, "form" if tag == "form" else "") for a in ("class", "id", "role") for n in values.get(a, "").split()}
        if tag == "header" and outer == INSIDE:  # the header of an article, whatever it calls itself
            names = " ".join(values.get(a, "") for a in ("class", "id", "role")).lower()
            return FURNITURE if set(_split.split(names)) & (FURNITURE_WORDS - {"header"}) else None
        if tag not in ("body", "html"):
            if 2 * FURNITURE in said or (FURNITURE in said and INSIDE not in said):
                return FURNITURE
        if tag not in FURNITURE_TAGS and INSIDE in said:
            return INSIDE
    if tag in ("article", "main"):
        return INSIDE
    if tag in ("form", "fieldset") and outer != FURNITURE and _wraps.search(rest()):
        return None
    if tag == "header" and outer == INSIDE:
        return None
    return FURNITURE if tag in FURNITURE_TAGS else None


def blocks(page: str) -> list[Block]:
    """Flat text blocks of a page in page order, without empty ones."""
    out: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    open_tags: list[tuple[str, int]] = []   # container and the place inside it
    links = heading = 0
    at = 0

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                n = text.count(" ") + 1
                in_links = len(html.unescape("".join(linked)).split())
                out.append(Block(text, open_tags[-1][1] if open_tags else NEITHER, heading, n, min(1.0, in_links / n)))
            parts.clear()
            linked.clear()

    def add(text: str) -> None:
        if text:
            parts.append(text)
            if links:
                linked.append(text + " ")

    for m in _markup.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag, end = tag.lower(), bool(m["end"])
        if tag in SPACE:
            parts.append(" ")
        if tag in BLOCK:
            flush()
        if tag == "a":
            links = 0 if end else 1
        elif tag in HEADING:
            heading = 0 if end else 1
            links = 0
        if tag in BLOCK and tag != "p":
            links = 0
        if tag not in CONTAINER:
            continue
        if end:
            for k in range(len(open_tags) - 1, -1, -1):
                if open_tags[k][0] == tag:
                    del open_tags[k:]
                    break
                if open_tags[k][0] in ("article", "body") and tag in ("p", "span", "li"):
                    break
        elif not m["attrs"].endswith("/"):
            if tag in ("p", "li") and open_tags and open_tags[-1][0] == tag:
                open_tags.pop()
            outer = open_tags[-1][1] if open_tags else NEITHER
            def rest(tag=tag, start=m.end()):
                end = _ends[tag].search(page, start)
                return page[start:end.start() if end else len(page)]
            own = _place(tag, m["attrs"], outer, rest)
            if own == INSIDE and tag not in ("article", "main") and outer == FURNITURE:
                own = None                      # the "content" of a sidebar is no article
            if tag not in ("p", "span", "li") or own is not None:
                open_tags.append((tag, outer if own is None else own))
    add(page[at:])
    flush()
    return out


FEATURES = ("place", "heading", "words", "density", "words_before", "density_before", "words_after", "density_after")
# Labelled blocks: the features in the order above, then 1 for a block of the article.
LABELLED = (
    # inside an article: paragraphs, short paragraphs, headings, lists, a paragraph with some links
    (1, 1, 8, 0.0, 6, 1.0, 60, 0.0, 1), (1, 1, 12, 0.0, 9, 0.0, 12, 0.0, 1), (1, 0, 60, 0.0, 8, 0.0, 45, 0.0, 1),
    (1, 0, 45, 0.02, 60, 0.0, 120, 0.1, 1), (1, 0, 120, 0.1, 45, 0.0, 5, 0.0, 1), (1, 0, 5, 0.0, 120, 0.0, 80, 0.0, 1),
    (1, 0, 1, 0.0, 80, 0.0, 40, 0.0, 1), (1, 0, 2, 0.0, 70, 0.0, 5, 0.2, 1), (1, 0, 14, 0.3, 50, 0.0, 30, 0.0, 1),
    (1, 0, 30, 0.45, 14, 0.3, 50, 0.0, 1), (1, 1, 4, 0.0, 50, 0.0, 33, 0.0, 1), (1, 0, 9, 0.0, 33, 0.0, 9, 0.0, 1),
    (1, 0, 9, 0.0, 9, 0.0, 7, 0.0, 1), (1, 0, 200, 0.0, 0, 0.0, 0, 0.0, 1), (1, 0, 3, 0.0, 0, 0.0, 0, 0.0, 1),
    (1, 1, 6, 1.0, 3, 0.0, 70, 0.0, 1), (1, 0, 18, 0.1, 6, 0.0, 6, 1.0, 1), (1, 0, 25, 0.0, 25, 0.0, 5, 0.5, 1),
    (1, 0, 11, 0.5, 40, 0.0, 38, 0.0, 1), (1, 0, 7, 0.0, 5, 1.0, 4, 1.0, 1),
    (1, 0, 12, 0.0, 40, 0.0, 3, 0.0, 1), (1, 0, 2, 0.0, 3, 0.0, 2, 0.0, 1), (1, 0, 4, 0.0, 2, 0.0, 1, 0.0, 1),
    (1, 0, 15, 0.0, 4, 0.0, 2, 1.0, 1), (1, 0, 6, 0.0, 8, 1.0, 3, 1.0, 1), (1, 1, 2, 0.0, 1, 1.0, 4, 0.0, 1),
    (1, 0, 3, 0.0, 90, 0.0, 4, 0.0, 1), (1, 0, 50, 0.0, 1, 1.0, 1, 1.0, 1), (1, 0, 1, 0.0, 1, 0.0, 1, 0.0, 1),
    (1, 1, 3, 0.0, 2, 1.0, 2, 1.0, 1), (1, 0, 5, 0.2, 70, 0.0, 0, 0.0, 1), (1, 0, 8, 0.4, 6, 1.0, 3, 1.0, 1),
    (1, 0, 9, 0.5, 3, 1.0, 40, 0.0, 1), (1, 0, 10, 0.0, 4, 0.0, 0, 0.0, 1), (1, 0, 4, 0.5, 4, 0.5, 4, 0.5, 1),
    (1, 0, 6, 0.6, 20, 0.0, 2, 0.0, 1), (1, 0, 2, 0.5, 2, 0.0, 0, 0.0, 1), (1, 0, 7, 0.0, 6, 0.0, 4, 0.0, 1),
    # inside an article: lists of links belong to it
    (1, 0, 1, 1.0, 40, 0.0, 1, 1.0, 1), (1, 0, 2, 1.0, 1, 1.0, 2, 1.0, 1), (1, 0, 4, 1.0, 2, 1.0, 3, 1.0, 1),
    (1, 0, 12, 0.95, 30, 0.0, 10, 0.9, 1), (1, 0, 8, 0.9, 4, 1.0, 0, 0.0, 1), (1, 0, 3, 1.0, 5, 0.0, 20, 0.0, 1),
    # furniture: menus, headers, footers, sidebars, notices, adverts, forms, comments, long ones too
    (-1, 0, 1, 1.0, 1, 1.0, 1, 1.0, 0), (-1, 0, 2, 1.0, 0, 0.0, 1, 1.0, 0), (-1, 0, 7, 0.0, 1, 1.0, 9, 0.0, 0),
    (-1, 0, 14, 0.0, 1, 1.0, 12, 0.0, 0), (-1, 0, 45, 0.1, 3, 0.0, 60, 0.0, 0), (-1, 0, 80, 0.0, 45, 0.0, 50, 0.0, 0),
    (-1, 0, 150, 0.0, 80, 0.0, 9, 0.0, 0), (-1, 0, 9, 0.2, 120, 0.0, 0, 0.0, 0), (-1, 0, 20, 0.0, 60, 0.0, 0, 0.0, 0),
    (-1, 1, 3, 0.0, 30, 0.0, 25, 0.0, 0), (-1, 1, 5, 0.0, 8, 0.0, 30, 0.0, 0), (-1, 0, 3, 0.0, 3, 0.0, 3, 0.0, 0),
    (-1, 0, 33, 0.0, 5, 0.0, 44, 0.0, 0), (-1, 0, 5, 0.6, 33, 0.0, 2, 1.0, 0), (-1, 0, 25, 0.0, 25, 0.0, 25, 0.0, 0),
    # neither: pages without a named article
    (0, 0, 40, 0.0, 5, 0.0, 60, 0.0, 1), (0, 0, 60, 0.05, 40, 0.0, 30, 0.0, 1), (0, 0, 25, 0.1, 60, 0.0, 80, 0.0, 1),
    (0, 0, 17, 0.0, 45, 0.0, 50, 0.0, 1), (0, 0, 8, 0.0, 50, 0.0, 45, 0.0, 1), (0, 0, 130, 0.0, 2, 1.0, 3, 1.0, 1),
    (0, 1, 7, 0.0, 2, 1.0, 55, 0.0, 1), (0, 1, 5, 0.0, 40, 0.0, 35, 0.0, 1), (0, 0, 12, 0.0, 30, 0.0, 90, 0.0, 1),
    (0, 0, 22, 0.2, 7, 0.0, 35, 0.0, 1), (0, 0, 35, 0.1, 22, 0.2, 6, 1.0, 1), (0, 0, 70, 0.3, 30, 0.1, 40, 0.0, 1),
    (0, 0, 24, 0.0, 5, 0.0, 22, 0.0, 1), (0, 0, 22, 0.0, 24, 0.0, 2, 0.0, 1), (0, 0, 20, 0.0, 24, 0.0, 16, 0.0, 1),
    (0, 0, 18, 0.0, 20, 0.0, 9, 0.0, 1), (0, 0, 26, 0.0, 4, 1.0, 5, 0.0, 1), (0, 1, 4, 0.0, 1, 1.0, 24, 0.0, 1),
    (0, 0, 28, 0.1, 6, 0.0, 21, 0.0, 1), (0, 0, 21, 0.0, 28, 0.1, 4, 1.0, 1), (0, 0, 16, 0.0, 30, 0.0, 25, 0.0, 1),
    (0, 0, 1, 1.0, 1, 1.0, 1, 1.0, 0), (0, 0, 3, 1.0, 1, 1.0, 4, 0.8, 0), (0, 0, 10, 0.8, 3, 1.0, 2, 1.0, 0),
    (0, 0, 25, 0.7, 10, 0.8, 12, 0.9, 0), (0, 0, 4, 0.0, 2, 1.0, 3, 1.0, 0), (0, 0, 6, 0.0, 3, 1.0, 4, 0.0, 0),
    (0, 0, 3, 0.0, 5, 0.0, 2, 0.0, 0), (0, 0, 8, 0.4, 60, 0.0, 3, 1.0, 0), (0, 0, 9, 0.5, 3, 1.0, 40, 0.0, 0),
    (0, 0, 40, 0.6, 3, 1.0, 3, 1.0, 0), (0, 0, 5, 0.0, 70, 0.0, 0, 0.0, 0), (0, 0, 7, 0.0, 6, 0.0, 4, 0.0, 0),
    (0, 1, 3, 0.0, 2, 1.0, 2, 1.0, 0), (0, 1, 4, 0.0, 12, 0.0, 3, 1.0, 0), (0, 0, 2, 0.0, 1, 1.0, 30, 0.0, 0),
)


def train(rows=LABELLED, least: int = 2):
    """Binary tree of lowest Gini impurity: a label, or (feature, threshold, tree below or equal, tree above).

    Ties go to the earlier feature and the lower threshold, so the tree is the
    same everywhere.
    """
    ones = sum(r[-1] for r in rows)
    if ones in (0, len(rows)) or len(rows) < 2 * least:
        return int(2 * ones >= len(rows))
    best = None
    for f in range(len(FEATURES)):
        values = sorted({r[f] for r in rows})
        for a, b in zip(values, values[1:], strict=False):
            cut = (a + b) / 2
            low, high = [r for r in rows if r[f] <= cut], [r for r in rows if r[f] > cut]
            score = sum(len(s) * 2 * (p := sum(r[-1] for r in s) / len(s)) * (1 - p) for s in (low, high))
            if best is None or score < best[0] - 1e-12:
                best = (score, f, cut, low, high)
    if best is None:
        return int(2 * ones >= len(rows))
    return best[1], best[2], train(best[3], least), train(best[4], least)


def classify(tree, row: tuple) -> int:
    while not isinstance(tree, int):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def main_text(page: str, tree) -> str:
    found = blocks(page)
    kept = []
    for k, b in enumerate(found):
        before = found[k - 1] if k else Block("", 0, 0, 0, 0.0)
        after = found[k + 1] if k + 1 < len(found) else Block("", 0, 0, 0, 0.0)
        if classify(tree, (b.place, b.heading, b.words, b.density, before.words, before.density,
                           after.words, after.density)):
            kept.append(b.text)
    return "\n".join(kept)


def html_text(pages: DataFrame, html_col: str = "html", out_col: str = "main_text", labelled=LABELLED) -> DataFrame:
    """``pages`` with a string column ``out_col``: the article of each page.

    All columns stay; the caller picks an ``out_col`` that ``pages`` lacks. No shuffle.
    """
    tree = train(labelled)

    def extract(pages_: pa.Array) -> pa.Array:
        return pa.array([main_text(t, tree) for a, b in slices(pages_) for t in text_list(pages_, a, b)], pa.string())

    return pages.withColumn(out_col, F.arrow_udf(extract, "string").asNondeterministic()(F.col(html_col).cast("string")))


def page_digest(pages: DataFrame) -> DataFrame:
    out = html_text(pages.select("page_id", "url", "html"))
    return out.select("page_id", "url", F.col("main_text").alias("text"),
                      F.char_length("main_text").cast("long").alias("n_chars"))
