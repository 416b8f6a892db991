"""Operator 1, main text of a web page by composite text density.

The page is parsed into a DOM once. Every node gets its composite text density: characters per
tag, lowered by the share of characters inside links. A node's density sum adds up the densities
of its children. The body is walked down: the threshold is the smallest density on the path from
the body to the node with the largest density sum (the path thresholds); of every branch whose nodes
reach it all the way down, the subtree with the largest sum is content, joined in page order. Text that is no article text wherever it
stands (scripts, styles, forms, menus, headers, footers, sidebars, notices, adverts, comments of
readers) is taken out by tag, role and class before, so it counts in no density. A class or id
only counts as such a mark if the element doesn't hold the article itself, and a compound one only if all
its parts are marks or name a place (``comment-list``; not ``ad-free`` or ``menu-planning``).

If an ``article`` or ``main`` element holds the densest subtree, all of that element's blocks but its
lists of links are kept: a short paragraph or heading beside long ones is article text too. The threshold then
is the smallest density on the path from the body to that element, and what else reaches it, further
articles and sections, is joined in page order. Without such an element the headings and paragraphs
right beside the chosen subtrees are added.

Defined results: null or empty html and a page without content give an empty text and 0
characters. Malformed markup is read as browsers do (implied ends of p, li, td and so on,
unclosed elements end with their parent). Each row is treated by itself: repeated rows repeat.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import read

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements without article text.
DROPPED = frozenset("script style noscript template svg math iframe object canvas head form nav footer aside button "
                    "select textarea input label option menu dialog audio video map datalist fieldset header".split())
#: What may stand beside the chosen subtree as part of the text.
BESIDE = frozenset("h1 h2 h3 h4 h5 h6 hgroup p br blockquote pre figure ul ol dl table b i em strong span time small".split())
#: Contents that are no markup until their own end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p "
                   "pre section summary table tbody td tfoot th thead tr ul".split())
#: An opening tag on the left ends an open element on the right, within the nearest of the third.
P_ENDERS = BLOCKS - frozenset("br body html caption td th tr tbody thead tfoot".split())
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
           "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
           "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"})}
SCOPES = frozenset("table td th caption button html template object".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
                  "toolbar".split())
#: Words of class and id that mark what is no article text, wherever it is and however long.
STRONG = ("nav navbar navigation menu submenu breadcrumb breadcrumbs masthead topbar footer foot colophon sidebar aside ad ads advert "
          "adverts advertisement advertisements advertising adsense adsbygoogle sponsor sponsors sponsored promo promos promotion "
          "promotions cookie cookies consent gdpr popup popups overlay newsletter subscribe subscription signup sharing recommend "
          "recommended recommendations comment comments commentlist disqus reply replies respond pagination pager skiplink skip-link "
          "paywall tagcloud toolbar").split()
#: Words that do so only on an element that holds less than half of the text around it.
WEAK = ("header banner side rail widget widgets notice notices alert alerts modal login search form forms share social related hidden "
        "copyright legal disclaimer tag tags").split()


#: What else a compound class or id may consist of: places, containers, kinds of blocks.
PLACES = frozenset("site page main top bottom left right inner outer list lists area section sections wrapper wrap box bar container block "
                   "blocks item items button buttons link links icon icons posts post articles panel group row col column content body title "
                   "head thread tree text image img unit slot zone region holder sticky fixed mobile desktop primary secondary global".split())
STRONG_MARKS, WEAK_MARKS = frozenset(STRONG), frozenset(WEAK)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: Containers that are menus if they hold nothing but links.
LINK_LISTS = frozenset("ul ol div section dl table p".split())
#: Elements that hold the page or the article are never dropped for a mark.
KEPT = frozenset("html body main article".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


class Node:
    __slots__ = ("tag", "parent", "items", "marked", "chars", "link_chars", "tags", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent = tag, parent
        self.items: list = []  # texts and nodes in page order
        self.marked = 0
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.total = 0.0


def _dropped(node: Node, tag: str) -> bool:
    return tag in DROPPED and not (tag == "header" and (_open(node, "article") or _open(node, "main")))


def _marks(tag: str, attributes: str) -> tuple[bool, int]:
    """(hidden or of a role without article text, marked by class or id: 0 no, 1 weakly, 2 strongly)."""
    gone, marked = False, 0
    if tag in KEPT:
        return False, 0
    for m in ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true":
            gone = True
        elif name == "role" and value.strip().lower() in ROLES:
            gone = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            gone = True
        elif name in ("class", "id"):
            marked = max([marked, *(_mark(token) for token in CAMEL.sub("-", value).lower().split())])
    return gone, marked


def _mark(token: str) -> int:
    """0, 1 or 2 for one class or id. Other parts than marks and places give it another meaning."""
    if token in STRONG_MARKS:
        return 2
    parts = {part.rstrip("0123456789") for part in re.split(r"[-_]+", token)} - {""}
    if not parts <= STRONG_MARKS | WEAK_MARKS | PLACES:
        return 0
    return 2 if parts & STRONG_MARKS else 1 if parts & WEAK_MARKS else 0


def parse(page: str) -> Node:
    """DOM of a page without the dropped elements. Void elements and comments make no node."""
    root = Node("html", None)
    at, node = 0, root
    skip: list[str] = []  # open elements inside a dropped one, the dropped one first
    found = TOKEN.search(page)
    while found:
        if found.start() > at and not skip:
            node.items.append(page[at:found.start()])
        at = found.end()
        if found[2] is None:
            if found[0].startswith("<![CDATA[") and not skip:
                node.items.append(entities.escape(found[0][9:].removesuffix("]]>"), False))
            found = TOKEN.search(page, at)
            continue
        tag, closing, rest = found[2].lower(), bool(found[1]), found[3]
        if not closing and tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif skip:
            if closing:
                if tag in skip:
                    while skip.pop() != tag:
                        pass
                elif tag in ("body", "html", "article", "main") or _open(node, tag) and tag in BLOCKS and tag != "p":
                    skip.clear()  # the dropped element was never closed: it ends with its parent
                    node = _close(node, tag)
            elif tag not in VOID and not rest.endswith("/"):
                if tag == "body" and skip[0] == "head" or tag in ("article", "main") and skip[0] in ("nav", "head"):
                    skip.clear()
                    node = _child(node, tag)
                else:
                    if tag in IMPLIED and skip[-1] in IMPLIED[tag][0]:
                        skip.pop()
                    if skip or tag not in IMPLIED:
                        skip.append(tag)
        elif closing:
            if tag == "br":
                node.items.append(Node("br", node))
            else:
                node = _close(node, tag)
        else:
            if tag in P_ENDERS:
                node = _end_paragraph(node)
            if tag in IMPLIED:
                node = _imply(node, tag)
            gone, marked = _marks(tag, rest) if rest and not rest.isspace() else (False, 0)
            if gone or _dropped(node, tag):
                if tag in BLOCKS:
                    node.items.append(Node("br", node))
                if tag not in VOID and not rest.endswith("/"):
                    skip.append(tag)
            elif tag in VOID or rest.endswith("/") and tag not in BLOCKS:
                if tag in ("br", "hr"):
                    node.items.append(Node("br", node))
            elif tag != "html":
                node = _child(node, tag)
                node.marked = marked
        found = TOKEN.search(page, at)
    if at < len(page) and not skip:
        node.items.append(page[at:])
    return root


def _prune(root: Node) -> None:
    """Take out the marked elements, but for those that hold an article and, of the weakly marked ones
    and on pages without an article, those that hold half of the text around them."""
    order = _measure(root)
    holds, around = set(), {id(root): root}
    for node in order:
        if node.tag in ("article", "main") and node.chars:
            here = node
            while here is not None and id(here) not in holds:
                holds.add(id(here))
                here = here.parent
    for node in reversed(order):  # parents first: the nearest article or main around each node
        if node.parent is not None:
            around[id(node)] = node if node.tag in ("article", "main") else around[id(node.parent)]
    for node in order:
        if node.marked and id(node) not in holds:
            bulk = 2 * node.chars >= around[id(node)].chars
            if not bulk or holds and node.marked == 2:
                node.items = []
                node.tag = "br" if node.tag in BLOCKS else "span"


def _child(node: Node, tag: str) -> Node:
    new = Node(tag, node)
    node.items.append(new)
    return new


def _open(node: Node | None, tag: str) -> bool:
    while node is not None:
        if node.tag == tag:
            return True
        node = node.parent
    return False


def _close(node: Node, tag: str) -> Node:
    """Close the nearest open ``tag``; an end tag that matches nothing is ignored. Inline end tags
    don't close blocks around them."""
    here = node
    while here.parent is not None:
        if here.tag == tag:
            return here.parent
        if tag not in BLOCKS and here.tag in BLOCKS or here.tag in SCOPES and tag not in ("table", "body", "html", "tr", "tbody",
                                                                                        "article", "main", "section", "div"):
            return node
        here = here.parent
    return node


def _end_paragraph(node: Node) -> Node:
    here = node
    while here.parent is not None and here.tag not in SCOPES:
        if here.tag == "p":
            return here.parent
        if here.tag in BLOCKS:
            return node
        here = here.parent
    return node


def _imply(node: Node, tag: str) -> Node:
    ended, bounds = IMPLIED[tag]
    here, to = node, node
    while here.parent is not None and here.tag not in bounds:
        if here.tag in ended:
            to = here.parent
        here = here.parent
    return to


def _measure(root: Node) -> list[Node]:
    """Characters, tags and densities of every node, without recursion; the nodes, children first."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(x for x in node.items if isinstance(x, Node))
    order.reverse()
    for node in order:
        node.chars = node.link_chars = node.tags = node.link_tags = 0
        for x in node.items:
            if isinstance(x, str):
                node.chars += len("".join(x.split()))
            else:
                node.chars += x.chars
                node.tags += x.tags + 1
                node.link_chars += x.link_chars
                node.link_tags += x.link_tags
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
    body_ratio = root.link_chars / max(1, root.chars)
    for node in order:
        node.density = _density(node, body_ratio)
        node.total = sum(x.density for x in node.items if isinstance(x, Node))
    return order


def _density(node: Node, body_ratio: float) -> float:
    """Composite text density: characters per tag, damped where links hold much of the text."""
    chars, tags = node.chars, max(1, node.tags)
    if not chars:
        return 0.0
    links, plain = max(1, node.link_chars), max(1, chars - node.link_chars)
    base = log(chars / plain * node.link_chars + body_ratio * chars + e)
    weight = chars / links * tags / max(1, node.link_tags)
    return chars / tags * (log(max(1.0, weight) + 1e-9) / log(base) if base > 1 else 1.0) if node.link_chars else chars / tags


def content(root: Node) -> list[Node | str]:
    """The subtrees that hold the main text, with what belongs to it beside them."""
    _prune(root)
    order = _measure(root)
    if not root.chars:
        return []
    body = next((n for n in reversed(order) if n.tag == "body" and n.chars), root)
    inner = [n for n in reversed(order) if n.chars and (n is body or _inside(n, body))]
    best = max(inner, key=lambda n: n.total)
    if not best.total:  # one text without any element in it
        best = max(inner, key=lambda n: n.chars)
    holder, here = None, best
    while here is not None:
        if here.tag == "article" or here.tag == "main" and holder is None:
            holder = here
        here = here.parent
    limit, here = (best if holder is None else holder).density, best if holder is None else holder
    while here is not body:  # the thresholds on the way from the body
        here = here.parent
        limit = min(limit, here.density)
    if holder is None:
        return _in_order(body, [best, *_dense(inner, body, limit)])
    _cut_link_lists(holder)
    others = [_section(n, body) for n in _dense(inner, body, limit) if 2 * n.link_chars <= n.chars]
    return _outermost(body, [holder, *others])


def _section(node: Node, body: Node) -> Node:
    """The largest article or section around ``node`` that holds no other one's text, else the node."""
    here, found = node, node
    while here is not body and here is not None:
        if here.tag in ("article", "section"):
            found = here
            if here.tag == "article":
                break
        here = here.parent
    return found


def _cut_link_lists(holder: Node) -> None:
    """Empty the lists and containers in ``holder`` whose text is links: menus without a mark."""
    stack = [holder]
    while stack:
        node = stack.pop()
        if node is not holder and node.tag in LINK_LISTS and 10 * node.link_chars >= 9 * node.chars > 0 and _links(node) >= 3 \
                and 2 * node.chars < holder.chars:
            node.items = []
        stack.extend(x for x in node.items if isinstance(x, Node))


def _links(node: Node) -> int:
    n, stack = 0, [node]
    while stack:
        here = stack.pop()
        n += here.tag == "a"
        stack.extend(x for x in here.items if isinstance(x, Node))
    return n


def _outermost(body: Node, chosen: list[Node]) -> list[Node]:
    """The chosen nodes that lie in no other one, in page order."""
    taken, out, stack = {id(n) for n in chosen}, [], [body]
    while stack:
        node = stack.pop()
        if id(node) in taken:
            out.append(node)
        else:
            stack.extend(x for x in reversed(node.items) if isinstance(x, Node))
    return out


def _dense(inner: list[Node], body: Node, limit: float) -> list[Node]:
    """The subtree with the largest sum of every node that is reached from the body through nodes of
    density ``limit`` or more. ``inner``: the body's nodes, parents first."""
    most = {id(n): n for n in inner}
    for node in reversed(inner):
        up = node.parent
        if node is not body and most[id(node)].total > most[id(up)].total:
            most[id(up)] = most[id(node)]
    reached, found = set(), {}
    for node in inner:
        if node.density >= limit and (node is body or id(node.parent) in reached):
            reached.add(id(node))
            found[id(most[id(node)])] = most[id(node)]
    return list(found.values())


def _in_order(body: Node, chosen: list[Node]) -> list[Node | str]:
    """The chosen subtrees and what belongs beside them, each once and in page order."""
    if any(n is body for n in chosen):
        return [body]
    taken = {id(n) for n in chosen}
    places: dict[int, set[int]] = {}
    at: dict[int, int] = {}  # places of the nodes among their parent's items
    for node in chosen:
        if at.get(id(node)) in places.get(id(node.parent), ()):
            continue
        here = node.parent
        while here is not body and id(here) not in taken:
            here = here.parent
        if here is body:  # not within another one
            parent, first, last = _spread(node, body, at)
            if parent is None:
                return [body]
            places.setdefault(id(parent), set()).update(range(first, last))
    out, stack = [], [(body, False)]
    while stack:
        x, whole = stack.pop()
        if whole:
            out.append(x)
        elif isinstance(x, Node):
            own = places.get(id(x), ())
            stack.extend((y, i in own) for i, y in reversed(list(enumerate(x.items))))
    return out


def _spread(chosen: Node, body: Node, places: dict[int, int]) -> tuple[Node | None, int, int]:
    """The chosen subtree and the plain headings, paragraphs and texts right beside it, as a range of a
    node's items; if that is all its parent has, the parent's neighbours too (none: all of the body)."""
    def plain(x) -> bool:
        return isinstance(x, str) or x.tag in BESIDE and 2 * x.link_chars <= x.chars

    while chosen is not body and chosen.parent is not None:
        items = chosen.parent.items
        if id(chosen) not in places:
            places.update((id(x), i) for i, x in enumerate(items) if isinstance(x, Node))
        first = places[id(chosen)]
        last = first + 1
        while first > 0 and plain(items[first - 1]):
            first -= 1
        while last < len(items) and plain(items[last]):
            last += 1
        if first > 0 or last < len(items):
            return chosen.parent, first, last
        chosen = chosen.parent
    return None, 0, 0


def _inside(node: Node, top: Node) -> bool:
    while node is not None:
        if node is top:
            return True
        node = node.parent
    return False


def text_of(nodes: list[Node | str]) -> str:
    """Blocks in page order: white space inside a block becomes one space, blocks are joined by one."""
    out, run, stack = [], [], list(reversed(nodes))
    marks = object()

    def flush() -> None:
        if run:
            block = " ".join(entities.unescape("".join(run)).split())
            if block:
                out.append(block)
            run.clear()

    while stack:
        x = stack.pop()
        if x is marks:
            flush()
        elif isinstance(x, str):
            run.append(x)
        else:
            block = x.tag in BLOCKS
            if block:
                flush()
                stack.append(marks)
            stack.extend(reversed(x.items))
    flush()
    return " ".join(out)


def main_text(page: str | None) -> str:
    if not page or not page.strip():
        return ""
    return text_of(content(parse(page)))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Id, url, text and n_chars of every row: a map over the rows, one page at a time."""
    kind = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(x.as_py()) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    [id_col, url_col, "text", "n_chars"])

    return pages.select(id_col, url_col, html_col).mapInArrow(
        run, f"`{id_col}` {kind[id_col]}, `{url_col}` {kind[url_col]}, text string, n_chars bigint")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
