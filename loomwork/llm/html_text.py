"""Main text of HTML pages by composite text density.

Method: a page becomes a tree of elements.  For every node, characters per tag, lowered by the share of
linked characters, is its composite text density; the sum of its children's densities is its density sum.
The node with the largest density sum is the core; the threshold is the least density on the path from
the core up to the body.  An article or main element around the core is the content.  Without one, from the
body down, every subtree of PROSE unlinked characters whose density reaches the threshold is content, cut
down to its own node of the largest density sum; around these, on the way up to the body, headings, whatever stands between two of them
and blocks of prose stay too, unless most of such a block is linked (but for lists and paragraphs between two of them).  Inside the content, blocks of elements that
never hold main text (navigation, headers, footers, asides, forms, scripts, styles, hidden ones, and those
whose role is one of these) are left out, as are menus: blocks of several links and no other text, below the
threshold and not between two paragraphs.  Linked headings, items, cells and single linked paragraphs stay.
A class or id that names notices, adverts, menus, comments and the like only marks a block: it is left out
if most of it is linked, or if it has no paragraph of prose and is short beside its siblings.  A class or id
that says nothing but comments, adverts, notices or menus ("comment-list", "cookie banner") is left out even
if it is prose, unless it wraps nearly all of the page.  Headings, and whatever holds the page's h1, an
article or main, are never left out by name.  Of the headers of an article the headings stay: they are its title.

Text: character references are decoded, white space inside a block becomes one space, blocks are trimmed
and joined in page order by one newline.

Defined results: null and empty pages, and pages without text, give an empty text.  Unclosed and stray tags are
mended as browsers do for p, li, cells, options and definitions; elements may be nested to any depth, and
work grows with the page alone.  Pages are read whole.  Repeated rows get equal results.  Columns other than those named are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content isn't markup; it ends with their own end tag.
RAW = frozenset("script style textarea title noscript iframe noframes xmp template svg math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
NEVER = frozenset("nav header footer aside form button select input dialog menu head script style title noscript iframe object embed template svg math textarea noframes xmp canvas audio video".split())
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|alert|popup|modal|newsletter|subscribe|signup|menu|navbar|nav|navigation|breadcrumbs?|sidebar|side|rail|widget|"
    r"comments?|replies|disqus|respond|related|recommend\w*|share|sharing|social|footer|header|masthead|copyright|legal|toolbar|pagination|pager|skip|login|search)(?:$|[\s_-])",
    re.I,
)
#: Of these names, and words for parts of a page, a whole class or id is made that is no title of a section.
STRICT = r"ads?|advert\w*|sponsor(?:s|ed)?|promos?|cookies?|consent|gdpr|notices?|alert|popup|modal|newsletter|subscribe|signup|menu|navbar|nav|breadcrumbs?|sidebar|comments?|replies|disqus|respond"
STRICTLY = re.compile(rf"(?:(?:{STRICT}|list|area|box|container|wrap|wrapper|section|block|bar|banner|form|slot|unit|thread|top|bottom|left|right|main|site|page|\d+)(?:[_-]+|$))+", re.I)
STRICT_NAME = re.compile(rf"(?:^|[_-])(?:{STRICT})(?:$|[_-])", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: A start tag closes an open element of these names.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())

MARK = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?|\"[^\"]*\"|'[^']*'", re.I)
SPACE = re.compile(r"\s+")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Unlinked characters, without spaces, that make a block a paragraph of prose.
PROSE = 60
LISTS = frozenset("p ul ol dl table".split())
#: Parts of lists and tables; blocks whose inline elements stand in running text.
PART = frozenset("li dt dd tr td th thead tbody tfoot caption figcaption".split())
TEXT = frozenset("p li dt dd td th caption figcaption blockquote pre".split()) | HEADINGS


class Node:
    __slots__ = ("name", "parent", "parts", "never", "named", "chars", "tags", "link_chars", "link_tags", "density", "total", "own", "paragraph")

    def __init__(self, name: str, parent: Node | None, never: bool = False, named: int = 0):
        self.name, self.parent, self.never, self.named = name, parent, never, named
        self.parts: list = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.own, self.paragraph = 0, False


def _never(name: str, attributes: str) -> tuple[bool, int]:
    """Whether an element never holds main text; 1 if its class or id hints at that, 2 if it says nothing else."""
    named = 0
    if name in NEVER:
        return True, named
    for key, value in ATTRIBUTE.findall(attributes) if attributes else ():
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id") and name not in ("html", "body", "article", "main") and name not in HEADINGS and NAMED.search(value):
            named = max(named, 2 if any(STRICT_NAME.search(x) and STRICTLY.fullmatch(x) for x in value.split()) else 1)
        if key == "role" and value.lower() in ROLES or key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True, named
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, named
    return False, named


class Open:
    """The elements that are open, outermost first, and where those of each name stand."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.places: dict[str, list[int]] = {}
        #: Places of the elements that aren't p or inline.
        self.solid = [0]

    def push(self, node: Node) -> None:
        self.places.setdefault(node.name, []).append(len(self.nodes))
        if node.name != "p" and node.name not in INLINE:
            self.solid.append(len(self.nodes))
        self.nodes.append(node)

    def close(self, place: int) -> None:
        """Closes the element at a place and all inside it."""
        for node in reversed(self.nodes[place:]):
            self.places[node.name].pop()
        del self.nodes[place:]
        while self.solid[-1] >= place:
            self.solid.pop()

    def innermost(self, names: Iterable[str]) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def outermost_above(self, names: Iterable[str], fence: int) -> int | None:
        """Place of the outermost open element of these names inside the one at fence."""
        found = [at[k] for n in names if (at := self.places.get(n)) and (k := bisect_right(at, fence)) < len(at)]
        return min(found, default=None)


def parse(page: str) -> Node:
    root = Node("#root", None)
    opened = Open(root)
    titles: list[Node] = []
    at, end = 0, len(page)
    while at < end:
        here = opened.nodes[-1]
        m = MARK.search(page, at)
        if not m:
            here.parts.append(page[at:])
            break
        if m.start() > at:
            here.parts.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if place := opened.innermost((name,)):
                opened.close(place)
            elif name in ("br", "p"):
                here.parts.append(Node(name, here))
            continue
        if name in CLOSES:
            place = opened.outermost_above(CLOSES[name], opened.innermost(SCOPE.get(name, ())))
        else:
            place = opened.outermost_above(("p",), opened.solid[-1]) if name in ENDS_P else None
        if place:
            opened.close(place)
            here = opened.nodes[-1]
        node = Node(name, here, *_never(name, m[3]))
        here.parts.append(node)
        if name == "header" and not opened.places.get("header") and (opened.places.get("article") or opened.places.get("main")):
            titles.append(node)
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = stop.end() if stop else end
        elif name not in VOID and not m[3].rstrip().endswith("/"):
            opened.push(node)
    for node in titles:
        node.parts = headings(node)
        node.never = not node.parts
    return root


def headings(node: Node) -> list[Node]:
    found, stack = [], [*reversed(node.parts)]
    while stack:
        p = stack.pop()
        if isinstance(p, str) or p.never:
            continue
        if p.name in HEADINGS:
            found.append(p)
        else:
            stack += reversed(p.parts)
    return found


def count(node: Node) -> None:
    """Characters and tags of a node from those of its parts; own: unlinked characters outside of blocks inside; paragraph: whether some block in it has PROSE of them."""
    node.chars = node.tags = node.link_chars = node.link_tags = node.own = 0
    node.paragraph = False
    if node.never:
        return
    inner = 0
    for p in node.parts:
        if isinstance(p, str):
            node.chars += len(p) - p.count(" ")
        elif not p.never:
            node.chars += p.chars
            node.tags += p.tags + 1
            node.link_chars += p.chars if p.name == "a" else p.link_chars
            node.link_tags += p.link_tags + (p.name == "a")
            if p.name not in INLINE:
                inner += p.chars - p.link_chars
                node.paragraph |= p.paragraph
    node.own = node.chars - node.link_chars - inner
    node.paragraph |= node.own >= PROSE


def drop_named(order: list[Node], body: Node) -> None:
    """Of the nodes whose class or id names what isn't main text, marks those that are left out."""
    for node in reversed(order):
        count(node)
    whole, holds = body.chars, set()
    for node in reversed(order):
        if node.parent and not node.never and (node in holds or node.name in ("article", "main", "h1")):
            holds.add(node.parent)
    longest: dict[Node, int] = {}
    for node in order:
        if not node.named or node.never or node in holds:
            continue
        inline, linked = node.name in INLINE, node.name == "a" or 2 * node.link_chars > node.chars
        if inline and node.parent.name in TEXT:
            continue
        if node.named == 2 and 10 * node.chars < 9 * whole:
            node.never = True
        elif linked:
            node.never = 10 * node.chars < 9 * whole
        elif node.name not in PART and not prose(node):
            if node.parent not in longest:
                longest[node.parent] = max((p.chars if isinstance(p, Node) else len(p) for p in node.parent.parts if not (isinstance(p, Node) and (p.never or p.named))), default=0)
            node.never = 2 * node.chars < longest[node.parent]


def measure(root: Node) -> Node:
    """Densities of all nodes; returns the body or the root."""
    order, body = [root], root
    for node in order:
        order += [p for p in node.parts if isinstance(p, Node)]
        if node.name == "body" and body is root:
            body = node
    if any(n.named for n in order):
        drop_named(order, body)
    for node in reversed(order):
        count(node)
    whole = body.link_chars / body.chars if body.chars else 0.0
    for node in reversed(order):
        if node.never or not node.chars:
            continue
        c, t, lc, lt = node.chars, max(1, node.tags), node.link_chars, max(1, node.link_tags)
        plain = max(1, c - lc)
        base = math.log(c / plain * lc + whole * c + math.e)
        ratio = c / max(1, lc) * t / lt
        node.density = c / t * (math.log(max(ratio, 1.0)) / math.log(base) if base > 1 else math.log(max(ratio, 1.0)))
        node.total = sum(p.density for p in node.parts if isinstance(p, Node))
    return body


def prose(node: Node) -> bool:
    """Whether most of a block is unlinked and some block without other blocks inside is a paragraph of prose."""
    if node.never or node.chars - node.link_chars < PROSE or 2 * node.link_chars > node.chars:
        return False
    return node.paragraph


def dense(body: Node, least: float) -> set[Node]:
    """Of every subtree whose density reaches the threshold, the node with the largest density sum."""
    order, best = [body], {}
    for node in order:
        order += [p for p in node.parts if isinstance(p, Node) and not p.never and p.name != "a"]
    for node in reversed(order):
        if node.name not in INLINE:
            below = best.get(node)
            best[node] = below if below and below.total > node.total else node
        if node is not body and (found := best.get(node)) and (node.parent not in best or found.total >= best[node.parent].total):
            best[node.parent] = found
    kept: set[Node] = set()
    todo = [body]
    for node in todo:
        if node in kept:
            continue
        if node.name not in INLINE and node.density >= least and (node is body or node.chars - node.link_chars >= max(PROSE, node.link_chars)):
            kept.add(best[node])
            if best[node] is node:
                continue
        todo += [p for p in node.parts if isinstance(p, Node) and not p.never and p.name != "a"]
    return kept


def around(body: Node, kept: set[Node]) -> dict[Node, list]:
    """For each node above the kept ones, those of its parts that are content."""
    above: set[Node] = set()
    for node in kept:
        while node is not body and node.parent not in above:
            node = node.parent
            above.add(node)
    out: dict[Node, list] = {}
    for node in above - kept:
        inner = [k for k, p in enumerate(node.parts) if isinstance(p, Node) and (p in kept or p in above)]
        chosen: list = []
        run: list = []
        for k, p in enumerate([*node.parts, None]):
            if isinstance(p, str) or p is not None and p.name in INLINE and p not in above:
                run.append(p)
                continue
            if run:
                plain = sum(len(x) - x.count(" ") if isinstance(x, str) else 0 if x.never or x.name == "a" else x.chars - x.link_chars for x in run)
                if plain >= PROSE or inner[0] < k <= inner[-1]:
                    chosen += run
                run = []
            if p is None:
                break
            if p in kept or p in above or p.name == "br" or p.name in HEADINGS and k < inner[-1] or prose(p) or inner[0] < k < inner[-1] and (2 * p.link_chars <= p.chars or p.link_tags < 2 or p.name in LISTS):
                chosen.append(p)
        out[node] = chosen
    return out


def menus(parts: list, least: float) -> set[Node]:
    """Those of a node's parts that are menus."""
    found = [
        k
        for k, p in enumerate(parts)
        if isinstance(p, Node) and p.link_tags > 1 and p.chars == p.link_chars and p.density < least and not p.never and p.name not in INLINE and p.name not in HEADINGS and p.name not in PART
    ]
    if not found:
        return set()
    run = [
        k
        for k, p in enumerate(parts)
        if (len(p) - p.count(" ") >= PROSE if isinstance(p, str) else not p.never and p.name not in INLINE and p.name not in HEADINGS and p.chars - p.link_chars >= (1 if p.name in ("p", "pre", "blockquote") else PROSE))
    ]
    return {parts[k] for k in found if not run or not run[0] < k < run[-1]}


def blocks(content: Node, least: float, chosen: dict[Node, list]) -> list[str]:
    """Texts of the blocks of content; of a node in chosen, only the parts given there."""
    out: list[str] = []
    line: list[str] = []

    def close() -> None:
        text = SPACE.sub(" ", entities.unescape("".join(line))).strip()
        if text:
            out.append(text)
        line.clear()

    left_out: set[Node] = set()
    stack: list = [content]
    while stack:
        p = stack.pop()
        if isinstance(p, str):
            line.append(p)
        elif p is None:
            close()
        elif p.never or p in left_out:
            if p.name not in INLINE:
                close()
        elif p.name == "br":
            line.append(" ")
        elif p.name in INLINE:
            stack += reversed(chosen.get(p, p.parts))
        else:
            close()
            parts = chosen.get(p, p.parts)
            if p.link_tags > 1 and p.name not in ("li", "dt", "dd"):
                left_out |= menus(parts, least)
            stack += [None, *reversed(parts)]
    close()
    return out


def main_text(page: str | None) -> str:
    body = measure(parse(page or ""))
    core, todo = body, [body]
    for node in todo:
        if node.never:
            continue
        todo += [p for p in node.parts if isinstance(p, Node)]
        if node.total > core.total:
            core = node
    path = [core]
    while path[-1] is not body and path[-1].parent:
        path.append(path[-1].parent)
    least = min(n.density for n in path)
    # An article or main element around the core is the author's own mark of the content.
    marked = [n for n in path if n.name in ("article", "main")]
    if marked:
        return "\n".join(blocks(marked[-1], least, {}))
    return "\n".join(blocks(body, least, around(body, dense(body, least))))


class HtmlText:
    def apply(self, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
        """page_id, url, text, n_chars: one row for each row of pages."""
        pages = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for low in range(0, batch.num_rows, 256):
                    part = batch.slice(low, 256)
                    texts = [main_text(h.as_py()) for h in part.column(2)]
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

        return pages.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
