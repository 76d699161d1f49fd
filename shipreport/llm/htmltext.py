"""Main text of web pages: flat text blocks, classified by a small decision tree.

A page is cut into blocks of text at block-level tags. Each block is described by its word
count and link density, by those of the blocks before and after it, and by what encloses
it. A decision tree, learnt from a small labelled table, tells main text from the rest.

The labelled table is made by rules: a few page layouts, filled with words that start with
``m`` where the text is the article and with ``b`` where it is not (``labelled_blocks``).
The tree is learnt from it in well under a second and sent to all tasks.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_START = re.compile(r"<(?=/?[a-zA-Z]|[!?])")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
#: A quote begins a value only right after an equals sign, and only if it is closed.
_TAG = re.compile(
    _NAME.pattern + r"((?:[\s/]++|(?:=[^\s/>=]*+|[^\s/>=]++)"
    r"(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s>]++))?+)*+)>")
_ATTRIBUTE = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")

#: Elements whose content is no text of the page.
SILENT = frozenset(("script", "style", "noscript", "template", "title", "textarea", "iframe", "svg", "object", "select"))
#: Those of them that hold no tags; without an end they go on to the end of the page.
RAW = frozenset(("script", "style", "title", "textarea", "iframe"))
#: Elements that begin and end a block.
BLOCK = frozenset(
    ("address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "div",
     "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
     "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary",
     "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"))
#: Elements without an end.
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
#: Elements that end where another of the same kind begins.
CLOSES = {"p": BLOCK, "li": frozenset(("li",)), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")),
          "tr": frozenset(("tr",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd"))}
#: Elements that hold no main text, but for a header of an article.
APART = frozenset(("nav", "footer", "aside", "form", "head", "header", "menu", "dialog", "button", "fieldset"))
#: Words in classes, ids and roles of elements that hold no main text.
HINTS = frozenset(
    ("ad", "ads", "advert", "advertisement", "adverts", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs",
     "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "copyright", "dialog",
     "discussion", "disqus", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation",
     "newsletter", "notice", "notices", "notification", "pager", "pagination", "popup", "promo", "promotion", "related",
     "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor",
     "sponsored", "subscribe", "subscription", "tags", "toolbar", "topbar", "widget"))


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    container: int
    apart: bool
    hint: bool
    heading: bool
    item: bool


class _Markup(NamedTuple):
    """A tag; or, without a name, a comment or declaration."""

    start: int
    end: int
    slash: str = ""
    tag: str | None = None
    attributes: str = ""

    @property
    def closed(self) -> bool:
        """It ends with a slash that is no part of a value without quotes."""
        rest = self.attributes.rstrip()
        if not rest.endswith("/"):
            return False
        return rest[-2:-1] in ("", '"', "'", "/") or rest[-2:-1].isspace() or "=" not in rest.split()[-1]


def _markup(page: str, at: int) -> _Markup | None:
    """The next markup from ``at``. What is never closed is text, but for comments, which go on to the end."""
    found = _START.search(page, at)
    if not found:
        return None
    start = found.start()
    for begin, stop in (("<!--", "-->"), ("<![CDATA[", "]]>")):
        if page.startswith(begin, start):
            end = page.find(stop, start + len(begin))
            return _Markup(start, len(page) if end < 0 else end + len(stop))
    tag = _TAG.match(page, start)
    if tag:
        return _Markup(start, tag.end(), tag[1], tag[2].lower(), tag[3])
    end = page.find(">", start)
    if end < 0:  # no tag ends after this place
        left = [x for x in (page.find("<!--", start), page.find("<![CDATA[", start)) if x >= 0]
        return _Markup(min(left), len(page)) if left else None
    name = _NAME.match(page, start)
    return _Markup(start, end + 1, name[1], name[2].lower(), page[name.end():end]) if name else _Markup(start, end + 1)


class _Open:
    """An element that is open, with what holds for all text inside it."""

    __slots__ = ("tag", "container", "apart", "hint", "heading", "item")

    def __init__(self, tag, above, attributes):
        self.tag = tag
        words = ()
        values = {}
        if attributes and ("class" in attributes or "id" in attributes or "role" in attributes or "hidden" in attributes
                           or "style" in attributes or "CLASS" in attributes or "ID" in attributes):
            values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
            named = " ".join(values.get(k, "") for k in ("class", "id", "role"))
            words = re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", named).lower())
        own = 2 if tag == "article" or "article" in words and tag in ("div", "section") else \
            1 if tag == "main" or values.get("role") == "main" else 0
        self.container = max(own, above.container if above else 0)
        in_article = above is not None and above.container == 2
        self.apart = (above.apart if above else False) or (tag in APART and not (tag == "header" and in_article))
        hidden = bool(attributes) and (re.search(r"(?:^|\s)hidden(?:\s|=|$)", attributes) is not None
                                       or values.get("aria-hidden") == "true"
                                       or "display:none" in values.get("style", "").replace(" ", ""))
        self.hint = (above.hint if above else False) or hidden or (
            tag not in ("html", "body") and any(w in HINTS for w in words))
        self.heading = (above.heading if above else False) or tag in ("h1", "h2", "h3", "h4", "h5", "h6")
        self.item = (above.item if above else False) or tag in ("li", "td", "th", "dt", "dd")


def _close(page: str, tag: str, at: int) -> int | None:
    close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
    return close.end() if close else None


def _after_silent(page: str, tag: str, at: int, stack: list[_Open], ends: bool) -> int:
    """Where the page goes on after a silent element that begins before ``at``.

    Without its end tag an element that is not RAW ends where the block around it does; an
    svg then ends before the first block inside it, as in browsers. ``ends``: an end tag of
    this kind follows.
    """
    if tag in RAW:
        return _close(page, tag, at) or len(page)
    around = {o.tag for o in stack}
    inside: list[str] = []
    depth, drawn, first = 1, 0, None
    for_html = ("foreignobject", "desc", "title")
    while found := _markup(page, at):
        at = found.end
        if found.tag is None:
            continue
        name, closed = found.tag, found.closed
        if name == tag and not (tag == "svg" and closed):
            depth += -1 if found.slash else tag != "select"
            if not depth:
                return at
        elif found.slash:
            if name in inside:
                while inside.pop() != name:
                    pass
            elif name in around:
                return first if first is not None else found.start
            drawn -= name in for_html and drawn > 0
        elif name in ("script", "style", "textarea", "iframe") and not (tag == "svg" and closed):
            at = _close(page, name, at) or len(page)
        elif name in BLOCK and name not in VOID:
            if tag == "svg" and first is None and not drawn:
                first = found.start
                if not ends:
                    return first
            inside.append(name)
        elif name in for_html:
            drawn += not closed
    return first if first is not None else len(page)


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in order; blocks without text are left out."""
    out: list[Block] = []
    held: list[str] = []
    linked: list[str] = []
    stack: list[_Open] = []
    links = 0
    last_ends: dict[str, int] = {}

    def ends(tag, at):
        if tag not in last_ends:
            last_ends[tag] = max((m.start() for m in re.finditer(f"</{tag}", page, re.I)), default=-1)
        return last_ends[tag] >= at

    def flush():
        if held:
            text = " ".join("".join(held).split())
            if text:
                top = stack[-1] if stack else _Open("body", None, "")
                out.append(Block(text, text.count(" ") + 1, len("".join(linked).split()), top.container, top.apart,
                                 top.hint, top.heading, top.item))
            held.clear()
            linked.clear()

    def say(text):
        if text:
            text = html.unescape(text)  # a reference never goes on behind a tag
            held.append(text)
            if links:
                linked.append(text)

    at, end = 0, len(page)
    while at < end:
        found = _markup(page, at)
        if not found:
            say(page[at:])
            break
        say(page[at:found.start])
        at, tag = found.end, found.tag
        if tag is None:
            continue
        if found.slash:
            if tag == "a":
                links = max(0, links - 1)
                linked.append(" ")
            elif tag in BLOCK:
                flush()
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i].tag == tag:
                        del stack[i:]
                        break
            continue
        if tag in SILENT:
            if tag != "svg" or not found.closed:
                at = _after_silent(page, tag, at, stack, ends(tag, at))
            if tag == "select":
                say(" ")
            continue
        if tag == "br":
            say(" ")
        elif tag == "a":
            links += not found.closed
        elif tag in BLOCK:
            flush()
            links = 0
            if stack and tag in CLOSES.get(stack[-1].tag, ()):
                stack.pop()
            if tag not in VOID and not found.closed:
                stack.append(_Open(tag, stack[-1] if stack else None, found.attributes))
    flush()
    return out


#: What the tree sees of a block.
FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
            "outside", "inside", "apart", "hint", "heading", "item")


def features(page: list[Block]) -> np.ndarray:
    if not page:
        return np.empty((0, len(FEATURES)))
    words = np.array([b.words for b in page], float)
    density = np.minimum(np.array([b.link_words for b in page]) / words, 1.0)
    before = lambda x: np.concatenate([[0.0], x[:-1]])
    after = lambda x: np.concatenate([x[1:], [0.0]])
    most = max((b.container for b in page if not b.apart and not b.hint), default=0)
    flags = np.array([(b.container < most, b.container == 2, b.apart, b.hint, b.heading, b.item) for b in page], float)
    return np.column_stack([words, density, before(words), before(density), after(words), after(density), flags])


def labelled_blocks() -> tuple[np.ndarray, np.ndarray]:
    """The labelled table: features of the blocks of a few layouts, and whether they are main text."""
    def say(letter, n):
        return " ".join(f"{letter}{i}" for i in range(n))

    def links(n, each=1, letter="b"):
        return "".join(f'<li><a href="/x">{say(letter, each)}</a></li>' for _ in range(n))

    def article(sizes):
        return f"<h1>{say('m', 6)}</h1>" + "".join(
            f"<p>{say('m', n)}" + (f' <a href="/y">{say("m", max(1, n // 12))}</a>' if n > 12 else "") + "</p>" for n in sizes)

    body = ((1,), (3, 60), (40, 80, 5), (120,), (25, 2, 30, 50), (8, 8, 8))
    pages = []
    for sizes in body:
        main = article(sizes)
        listed = main + f"<ul><li>{say('m', 4)}</li><li>{say('m', 9)}</li></ul><blockquote>{say('m', 15)}</blockquote>"
        for short, long in ((2, 12), (6, 40)):
            b1, b2 = say("b", short), say("b", long)
            pages += [
                f"<nav><ul>{links(5)}</ul></nav><div class=ad>{b2}</div><article>{main}</article><footer>{b1}</footer>",
                f"<header><div>{b1}</div><ul>{links(4, 2)}</ul></header><main>{listed}</main><aside><p>{b2}</p></aside>"
                f"<form><p>{b1}</p><button>{say('b', 1)}</button></form>",
                f"<div id=menu>{links(6)}</div><div id=content>{listed}</div><div class='comments'><p>{b2}</p><p>{b1}</p></div>"
                f"<div class=footer>{b1}</div>",
                f"<div class='cookie-notice'>{b2}</div><div>{main}</div><ul>{links(5, 4)}</ul>",
                f"<article><header>{main}</header><section class=comments><p>{b2}</p></section></article><div><p>{b2}</p></div>",
                f"<table><tr><td>{links(4, 3)}</td><td>{main}</td></tr></table><div>{links(3, 2)}</div>",
                f"<p><a href=/>{b1}</a> <a href=/a>{b2}</a></p>{main}",
                f"<header><p>{b2}</p></header>{main}<footer><p>{b2}</p></footer>",
                f"<div>{main}<aside><p>{b2}</p></aside></div><footer>{b1}</footer>",
                f"<article>{main}<aside>{b2}</aside><p>{say('m', 7)}</p><footer>{b1}</footer><form>{b2}</form></article>",
                f"<nav>{links(3)}</nav><article>{main}<ul>{links(6, 2, 'm')}</ul><p>{say('m', 20)}</p></article><ul>{links(4, 2)}</ul>",
                f"<article><ol>{links(4, 1, 'm')}</ol>{main}<ul>{links(3, 12, 'm')}</ul><nav>{links(4)}</nav></article>",
                f"<div>{main}<nav>{b1}</nav><p><a href=/z>{say('m', long)}</a></p><p>{say('m', 30)}</p></div>",
            ]
    x, y = [], []
    for page in pages:
        found = blocks(page)
        x.append(features(found))
        y += [b.text[0] == "m" for b in found]
    return np.concatenate(x), np.array(y)


@dataclass
class Tree:
    """A binary decision: ``feature`` at most ``cut`` goes low; a leaf has a label."""

    label: bool
    feature: int = -1
    cut: float = 0.0
    low: "Tree | None" = None
    high: "Tree | None" = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.low is None:
            return np.full(len(x), self.label)
        below = x[:, self.feature] <= self.cut
        out = np.empty(len(x), bool)
        out[below], out[~below] = self.low.predict(x[below]), self.high.predict(x[~below])
        return out


def grown(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 4) -> Tree:
    """A tree by Gini impurity; ties go to the earlier feature and the lower cut."""
    label = bool(y.mean() >= 0.5)
    if depth == 0 or y.all() or not y.any():
        return Tree(label)
    best, split = y.mean() * (1 - y.mean()) * len(y) - 1e-9, None
    for j in range(x.shape[1]):
        order = np.argsort(x[:, j], kind="stable")
        values, ones = x[order, j], np.cumsum(y[order])
        at = np.flatnonzero(values[1:] > values[:-1]) + 1
        at = at[(at >= least) & (len(y) - at >= least)]
        if not len(at):
            continue
        left, right = ones[at - 1], ones[-1] - ones[at - 1]
        impurity = left * (1 - left / at) + right * (1 - right / (len(y) - at))
        if impurity.min() < best - 1e-9:
            i = at[impurity.argmin()]
            best, split = impurity.min(), (j, (values[i - 1] + values[i]) / 2)
    if split is None:
        return Tree(label)
    below = x[:, split[0]] <= split[1]
    return Tree(label, *split, grown(x[below], y[below], depth - 1, least), grown(x[~below], y[~below], depth - 1, least))


@lru_cache(maxsize=1)
def learnt() -> Tree:
    return grown(*labelled_blocks())


def main_text(pages: list[str], tree: Tree) -> list[list[str]]:
    """The main blocks of each page."""
    cut = [blocks(p) for p in pages]
    x = [features(c) for c in cut]
    chosen = tree.predict(np.concatenate(x)) if x else np.empty(0, bool)
    out, at = [], 0
    for c in cut:
        out.append([b.text for b, own in zip(c, chosen[at:at + len(c)].tolist()) if own])
        at += len(c)
    return out


def extracted(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """``pages`` with text (main blocks joined by two line feeds) in place of any such column.

    NULL and empty pages, and pages without main text, have an empty text.
    """
    shared = pages.sparkSession.sparkContext.broadcast(tree or learnt())
    rows = pages.drop("text").withColumn("text", F.lit(""))

    def run(batches):
        for batch in batches:
            held = batch.column("html").to_pylist()
            text = []
            for low in range(0, len(held), 128):
                text += ["\n\n".join(found) for found in main_text([h or "" for h in held[low:low + 128]], shared.value)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(text, pa.string()) if n == "text" else c for n, c in zip(batch.schema.names, batch.columns)],
                names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def digest(pages: DataFrame) -> DataFrame:
    found = extracted(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
