"""Main text of HTML pages by tree scoring.

The page becomes a tree (unclosed and implied end tags repaired). Subtrees that
are never article text (navigation, headers, footers, asides, forms, scripts,
styles, hidden elements, and elements whose role, class or id names an advert,
notice, menu, comment section and the like) are cut off. Every paragraph then
passes points for its length and its commas to its ancestors, fewer with the
distance; a container's points are discounted by its link density. The best
container (or the article or main element it lies in) and what scores or reads
like article text beside it, on every level, are kept, and their blocks are
written one per line. Of a header inside an article only the headings stay.

One narrow pass, no shuffle, a page at a time. Defined results: null and empty
html give an empty text; a page without any paragraph gives the text of its
article or main element, else of what is left of the body; broken tags are read
as far as they go; repeated rows are extracted each; extra columns are not read.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, slices

#: possessive, so that broken tags cost one scan; quoted values may hold ">"
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)|[^>]*+)>", re.S)
_ATTR = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PARTS = re.compile(r"[a-z0-9]+|[A-Z][a-z0-9]*")
# names of HTML (fixed values)
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html",
    "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: an opening tag closes these if they are open inside the nearest of the second set
CLOSES = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
CUT_TAGS = {
    "nav", "header", "footer", "aside", "form", "button", "select", "input", "label", "fieldset", "svg", "canvas",
    "object", "applet", "audio", "video", "map", "menu", "dialog", "head",
}
CUT_ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "form",
    "menu", "menubar", "toolbar", "tablist",
}
CUT_NAMES = {
    "ad", "ads", "adv", "advert", "advertisement", "adverts", "adsense", "banner", "breadcrumb", "breadcrumbs",
    "alert", "alerts", "comment", "comments", "consent", "cookie", "cookies", "discussion", "disqus", "dropdown", "footer", "gdpr", "header",
    "login", "masthead", "menu", "menus", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
    "pager", "pagination", "popular", "popup", "promo", "promos", "promotion", "recommended", "related", "replies", "reply", "respond", "rail",
    "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "thread", "threads", "toc", "toolbar", "trending", "widget",
}
KEEP_NAMES = {"article", "body", "content", "entry", "main", "post", "story", "text"}
#: a class that tells of a layout ("has-sidebar"), not of its element
STATES = {"has", "no", "with", "without"}
#: a part's header of these holds its title
TITLED = {"article", "entry", "post", "story"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
NEVER_CUT = {"html", "body", "article", "main"}
START = {"article": 25, "main": 20, "section": 5, "div": 5, "blockquote": 3, "pre": 3, "td": 3}
LOW_START = {"ol": -3, "ul": -3, "dl": -3, "address": -3, "li": -3, "dd": -3, "dt": -3, "th": -5}
PARAGRAPH = {"p", "pre", "td", "blockquote", "li", "dd", "figcaption", "div", "section", "article", "main", "body"}
SHORT = 25


class Node:
    __slots__ = ("tag", "parent", "kids", "score", "own", "length", "linked", "commas", "links")

    def __init__(self, tag, parent):
        self.tag, self.parent = tag, parent
        self.kids: list = []  # nodes and texts in page order
        self.score = 0.0
        self.own = self.length = self.linked = self.commas = self.links = 0


def _fate(tag: str, attrs: str, inside: bool) -> str:
    """"cut", "keep" or "title" (only the headings stay) for an element; ``inside`` an article or main element.

    A name that says what the whole element is (``comments``, ``ad``) cuts it, whatever stands beside it. A name that
    only contains such a word (``content-sidebar``) cuts it unless the id or the class consists of keep names.
    """
    if tag == "header" and inside:
        return "title"
    if tag in CUT_TAGS:
        return "cut"
    if tag in NEVER_CUT or not attrs:
        return "keep"
    whole = part = kept = title = False
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return "cut"
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return "cut"
        if name == "role" and value.lower() in CUT_ROLES:
            return "cut"
        if name in ("class", "id"):
            named = [{x.lower() for x in _PARTS.findall(word)} for word in value.split()]
            kept |= bool(named) and all(n and n <= KEEP_NAMES for n in named)
            for names in named:
                bad = names & CUT_NAMES
                if "header" in names and names & TITLED and bad == {"header"}:
                    title = True
                elif bad and not names & STATES:
                    whole |= names <= CUT_NAMES
                    part = True
    if whole or part and not kept:
        return "cut"
    return "title" if title else "keep"


def _declaration_end(page: str, lt: int) -> int:
    """Where the comment, CDATA section or declaration that starts at ``lt`` ends; 0 if there is none."""
    if page.startswith("<!--", lt):
        end = page.find("-->", lt + 4)
        return len(page) if end < 0 else end + 3
    if page.startswith(("<!", "<?"), lt):
        end = page.find("]]>", lt) if page.startswith("<![CDATA[", lt) else -1
        end = end + 3 if end >= 0 else page.find(">", lt) + 1
        return end or len(page)
    return 0


def parse(page: str) -> Node:
    """The tree of a page without the subtrees that cannot be article text."""
    root = Node("html", None)
    open_, titled = [root], []
    cut_depth = 0  # how many open elements the cut subtree starts below; 0 outside
    at, n = 0, len(page)
    last = page.rfind(">")  # no tag ends after it
    low = None
    while at < n:
        lt = page.find("<", at)
        m = _TAG.match(page, lt) if 0 <= lt < last else None
        skip = _declaration_end(page, lt) if m is None and lt >= 0 else 0
        end = n if lt < 0 else m.end() if m else skip or lt + 1
        if not cut_depth:
            text = page[at : end if m is None and not skip else lt]
            if text:
                open_[-1].kids.append(text)
        at = end
        if m is None:
            continue
        tag = m[2]
        tag = tag.lower()
        if m[1]:
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].tag == tag:
                    del open_[i:]
                    if len(open_) < cut_depth:
                        cut_depth = 0
                    break
                if open_[i].tag in ("article", "main", "body", "table", "td") and tag not in BLOCK:
                    break  # a stray inline end tag closes no container
            continue
        if tag in RAW:
            low = page.lower() if low is None else low
            end = low.find(f"</{tag}", at)
            if len(low) != n:  # lower-casing can change lengths; search the page itself then
                found = re.compile(f"</{re.escape(tag)}", re.I).search(page, at)
                end = found.start() if found else -1
            at = n if end < 0 else end
            close = page.find(">", at)
            at = n if close < 0 else close + 1
            continue
        if tag in ("html", "body") and any(x.tag == tag for x in open_[1:]) or tag == "html":
            continue
        if tag in BLOCK or tag in CUT_TAGS:  # a block ends an open paragraph
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].tag == "p":
                    del open_[i:]
                    break
                if open_[i].tag in BLOCK:
                    break
        if tag in CLOSES:
            shut, within = CLOSES[tag]
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].tag in shut:
                    del open_[i:]
                    break
                if open_[i].tag in within:
                    break
        if len(open_) < cut_depth:
            cut_depth = 0
        if tag in VOID or m[3].rstrip().endswith("/") and tag not in BLOCK:
            if not cut_depth and tag in ("br", "hr", "img", "wbr"):
                open_[-1].kids.append(" " if tag == "br" else "" if tag != "hr" else Node("hr", open_[-1]))
            continue
        node = Node(tag, open_[-1])
        if not cut_depth:
            fate = _fate(tag, m[3], tag == "header" and any(x.tag in ("article", "main") for x in open_))
            if fate == "cut":
                cut_depth = len(open_) + 1
            else:
                open_[-1].kids.append(node)
                if fate == "title":
                    titled.append(node)
        open_.append(node)
    for node in titled:  # of an article's header only the headings stay
        heads = [x for x in _walk(node) if x.tag in HEADINGS and not any(y.tag in HEADINGS for y in _above(x, node))]
        node.tag, node.kids = "header", heads
        for x in heads:
            x.parent = node
    return root


def _above(node: Node, top: Node):
    """The nodes between a node and ``top``."""
    node = node.parent
    while node is not None and node is not top:
        yield node
        node = node.parent


def _walk(root: Node) -> list[Node]:
    """All nodes, parents first."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(k for k in reversed(node.kids) if isinstance(k, Node))
    return out


def _measure(nodes: list[Node]) -> None:
    """Text lengths, commas and linked lengths of every subtree; ``own`` is text outside inner blocks."""
    for node in reversed(nodes):
        for kid in node.kids:
            if isinstance(kid, Node):
                node.length += kid.length
                node.commas += kid.commas
                node.links += kid.links + (kid.tag == "a")
                node.linked += kid.length if kid.tag == "a" else kid.linked
                if kid.tag not in BLOCK:
                    node.own += kid.own
            else:
                size = len(" ".join(kid.split()))
                node.length += size
                node.own += size
                node.commas += kid.count(",")


def _score(nodes: list[Node]) -> None:
    for node in nodes:
        node.score = START.get(node.tag, LOW_START.get(node.tag, 0))
    for node in nodes:
        if node.tag not in PARAGRAPH or node.own < SHORT:
            continue
        density = node.linked / node.length if node.length else 0
        points = (1 + min(node.commas, 20) + min(node.own / 100, 3)) * (1 - density)
        share, up, level = 1.0, node if node.tag not in ("p", "li", "pre", "dd") else node.parent, 0
        while up is not None and share > 0.05:
            up.score += points * share
            level += 1
            share = 1 / 2 if level == 1 else 1 / (3 * level)
            up = up.parent


def _blocks(node: Node) -> list[str]:
    """Texts of the blocks below a node in page order, references decoded and white space made one."""
    out: list[str] = []
    held: list[str] = []

    def flush():
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append(text)

    todo: list = [node]
    while todo:
        now = todo.pop()
        if now is None:
            flush()
        elif isinstance(now, str):
            held.append(now)
        elif now.tag in BLOCK:
            flush()
            if now is not node and now.tag in ("ul", "ol", "dl", "table", "div", "section") and now.length:
                if now.links >= 3 and now.linked > 0.66 * now.length and now.linked < SHORT * now.links:
                    continue  # a menu inside the article; references have longer link texts
            todo.append(None)
            todo.extend(reversed(now.kids))
        else:
            todo.extend(reversed(now.kids))
    flush()
    return out


def _level(best: Node) -> list[Node]:
    """The blocks beside ``best``; a run of loose texts and inline elements is one of them."""
    level: list[Node] = []
    for kid in best.parent.kids:
        if isinstance(kid, Node) and kid.tag in BLOCK:
            level.append(kid)
            continue
        if not level or level[-1].tag != "loose":
            level.append(Node("loose", best.parent))
        level[-1].kids.append(kid)
    for run in level:
        if run.tag == "loose":
            _measure([run])
    return level


def _belongs(kid: Node, need: float, wrapped: bool) -> bool:
    """Whether a block beside the best container is article text: it scores like it, or it is unlinked
    text. In a wrapper of the article's own any unlinked block is, on the page's own level it has to read like text."""
    density = kid.linked / kid.length if kid.length else 0
    if wrapped:
        return kid.length > 0 and density < 0.25
    if kid.tag == "p":
        return kid.length > 80 and density < 0.25 or density == 0 and kid.length >= SHORT and kid.commas > 0
    if kid.tag in ("loose", "ul", "ol", "dl"):
        return kid.length >= SHORT and density < 0.25
    return kid.length > 0 and kid.score * (1 - density) >= need


def _with_siblings(best: Node) -> list[Node]:
    """``best`` and what belongs to it on its level, with the headings and by-lines before kept blocks."""
    need, wrapped = max(10, 0.2 * best.score), best.parent.tag not in ("body", "html")
    level = _level(best)
    keep = [kid is best or kid.tag not in HEADINGS and _belongs(kid, need, wrapped) for kid in level]
    last, between = False, []  # whether the next block that is no heading is kept; short unlinked blocks before it
    for i in range(len(level) - 1, -1, -1):
        kid = level[i]
        if kid.tag in HEADINGS:
            keep[i] = last
            if last:
                for j in between:  # a by-line between a title and its text
                    keep[j] = True
            between = []
        elif keep[i]:
            last, between = True, []
        elif kid.length and last and kid.length <= 80 and not kid.links:
            between.append(i)
        elif kid.length:
            last, between = False, []
    return [kid for kid, good in zip(level, keep, strict=True) if good]


def _article(best: Node) -> list[Node]:
    """The article's nodes in page order: the article or main element of ``best`` and its siblings, else
    ``best`` with what belongs to it on every level up to the body."""
    up = best
    while up is not None and up.tag not in ("article", "main"):
        up = up.parent
    if up is not None:
        return _with_siblings(up) if up.parent is not None else [up]
    kept, node = [best], best
    while node.parent is not None:
        beside = _with_siblings(node)
        at = next(i for i, x in enumerate(beside) if x is node)
        kept = beside[:at] + kept + beside[at + 1 :]
        top = node.parent
        top.score = max(top.score, node.score)
        node = top
        if node.tag in ("body", "html"):
            break
    return kept


def main_text(page: str | None) -> str:
    """The article's blocks, one per line; empty if there is none."""
    if not page:
        return ""
    root = parse(page)
    nodes = _walk(root)
    _measure(nodes)
    _score(nodes)
    box = [x for x in nodes if x.length and (x.tag in START or x.tag in ("body", "html", "table", "tbody", "tr"))]
    if not box:
        return "\n".join(_blocks(root))
    best = max(box, key=lambda x: x.score * (1 - x.linked / x.length))
    return "\n".join(b for k in _article(best) for b in _blocks(k))


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                texts = [main_text(h) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars"],
                )

    slim = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return bounded_batches(slim).mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
