"""Main text of web pages by composite text density.

Every block element of the page's tree gets a density: its characters per tag,
adjusted by the share of link characters and link tags (menus and link lists
come out low, running text high).  The densities of an element's children add up
to its density sum, and the element with the greatest sum holds the article.  The
least density on the path from the body to that element is the threshold: other
subtrees that reach it (an article may be split) are taken as well.

What is taken is taken whole.  Around the element with the greatest sum that is the
``article`` or ``main`` it lies in.  On pages without those density decides: from that
element upwards every ancestor is taken as long as all that lies beside the path
belongs to the text.  A list of links (two links or more that make up most of a block) does
not; a bare container (``div``, ``table`` ...) does where its density reaches that of the path,
as far as that holds no list of links.
Other ``article`` elements that are no such lists, and an ``h1`` beside the path, are taken too.

Elements that say themselves that they are no article text are left out of the tree first:
by their tag or role (scripts, forms, menus, sidebars, footers ...), or by a class or id word
whose last telling part names such a thing (``cookie-notice``, ``ad-slot-2``, but not
``menu-recipe`` or ``paywall-content``, nor a state as in ``has-sidebar``).  A word alone
drops nothing: an element so marked stays when it holds most of the text of its article (or page), an
article's ``h1``, or, whatever marks it, an ``article`` or ``main`` longer than every one
outside such elements.  Optional end tags are implied in them as elsewhere.
Inline marks are no nodes: their text belongs to the block around them.

Defined results: null and empty pages, and pages without text, give an empty
text; cut-off and malformed pages are read as far as they go; rows are
extracted each; a page's whole text is used, without caps.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Element names and class words of HTML pages.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table caption tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("head title script style noscript template iframe object svg math canvas audio video map button select textarea input label datalist form nav menu aside footer header dialog".split())
CLOSES_P = BLOCKS
#: Dropped elements whose content is no markup of the page, and what ``head`` may hold.
OPAQUE = frozenset("head title script style noscript template iframe object svg math select textarea".split())
IN_HEAD = frozenset("base basefont bgsound link meta title script style noscript template".split())
BREAKS_OUT = BLOCKS - {"html", "head", "body"}
SIBLINGS = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promoted cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription paywall sidebar menu nav navbar navigation breadcrumb breadcrumbs comment comments commentlist disqus replies respond related recommended share sharing social pagination pager masthead footer toolbar login signup discussion discussions copyright colophon".split()
)
#: Beside a noise word these tell of a page's state: ``has-sidebar``, ``comments-open``.
STATES = frozenset("has have with no not without hide hidden show open opened closed on off enabled disabled".split())
#: Parts of a class word that only say what kind of box it is: ``ad-container-2`` is an ``ad``.
BOXES = frozenset("left right top bottom inner outer primary secondary list lists container wrapper wrap box area section block widget widgets button buttons slot unit bar panel zone row col column link links item items form media this us posts articles stories".split())
#: Bare containers: beside the path their density tells whether they belong to the text.
BARE = frozenset("div table td center".split())
NOISE_NAMES = frozenset("header site-header page-header top-header site-footer page-footer skip-link search search-form".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())


class Node:
    """A block: its text pieces and child blocks in order, and its counts."""

    __slots__ = ("tag", "parent", "items", "skip", "marked", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, skip: bool = False, marked: bool = False) -> None:
        self.tag, self.parent, self.skip, self.marked = tag, parent, skip, marked
        self.items: list = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0

    def children(self) -> list[Node]:
        return [x for x in self.items if isinstance(x, Node)]


def is_mark(token: str) -> bool:
    """Whether a class or id word names something that is no article text."""
    parts = [x for x in token.replace("_", "-").split("-") if x]
    if token in NOISE_NAMES or not STATES.isdisjoint(parts):
        return token in NOISE_NAMES
    while parts and (parts[-1] in BOXES or parts[-1].isdigit()):
        parts.pop()
    return bool(parts) and parts[-1] in NOISE_WORDS


def noise_of(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> str:
    """``sure`` by tag, role or being hidden, ``marked`` by a class or id word, else empty."""
    if tag in ("html", "body", "main", "article") or (tag == "header" and in_article):
        return ""
    if tag in DROPPED:
        return "sure"
    out = ""
    for name, value in attrs:
        value = (value or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return "sure"
        if name == "style" and "display:none" in value.replace(" ", ""):
            return "sure"
        if name == "role" and value in NOISE_ROLES:
            return "sure"
        if name in ("class", "id") and any(map(is_mark, value.split())):
            out = "marked"
    return out


class TreeBuilder(HTMLParser):
    """Block tree of a page; elements marked as no article text are nodes to be skipped."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", None)
        self.at = self.root
        self.link: Node | None = None  # the block in which a link is open
        self.named: list[Node] = []  # article and main elements
        self.marks: list[Node] = []  # elements marked by a class or id word
        self.inline: set[str] = set()  # tags of marked elements that are no blocks

    def _close(self, node: Node) -> None:
        """Close ``node`` and everything open in it."""
        inner = self.at
        while inner is not node:
            if inner is self.link:
                self.link = None
            inner = inner.parent
        if node is self.link:
            self.link = None
        self.at = node.parent or self.root

    def _find(self, tags: str | tuple, stop: str = "", noise: bool = True) -> Node | None:
        """The innermost open element of ``tags``, up to one of ``stop`` (or a skipped block)."""
        tags, stops = (tags.split() if isinstance(tags, str) else tags), stop.split()
        n = self.at
        while n is not None and n is not self.root:
            if n.tag in tags:
                return n
            if n.tag in stops or (not noise and n.skip and n.tag in BLOCKS):
                return None
            n = n.parent
        return None

    def _opaque(self) -> bool:
        return self.at.skip and self.at.tag in OPAQUE

    def _leave_head(self) -> None:
        if self.at.skip and self.at.tag == "head":
            self._close(self.at)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "body":
            if (head := self._find(("head",))) is not None:
                self._close(head)
            return
        if tag == "html":
            return
        if self.at.tag == "head" and tag not in IN_HEAD:
            self._leave_head()
        if tag in BREAKS_OUT:  # a block ends a drawing or formula that was left open
            while self._opaque() and self.at.tag in ("svg", "math"):
                self._close(self.at)
        if self._opaque() and not (self.at.tag == "head" and tag in IN_HEAD):  # only its own kind of tag matters
            if tag == self.at.tag and tag not in VOID:
                self.at = self._child(tag, True)
            return
        if tag in BLOCKS and (p := self._find("p", "button table td th")) is not None:
            self._close(p)
        if tag in SIBLINGS:
            same, stop = SIBLINGS[tag]
            while (n := self._find(same, stop, False)) is not None:
                self._close(n)
        if tag == "a" and tag in self.inline and (n := self._find(("a",))) is not None:
            self._close(n)
        noise = noise_of(tag, attrs, self._find("article main") is not None)
        if tag == "br" or tag in VOID:
            self.at.items.append(" ") if tag in ("br", "hr", "wbr") and tag != "wbr" else None
            return
        if noise:
            self.at = self._child(tag, True)
            self.at.marked = noise == "marked"
            if self.at.marked:
                self.marks.append(self.at)
            if tag not in BLOCKS:
                self.inline.add(tag)
        elif tag in BLOCKS or (tag != "a" and tag in self.inline and self._find((tag,)) is not None):  # or inside a skipped one of its kind
            self.at = self._child(tag, False)
            if tag in ("article", "main"):
                self.named.append(self.at)
        elif tag == "a":
            self.link = self.at
            self.at.link_tags += 1

    def _child(self, tag: str, skip: bool) -> Node:
        node = Node(tag, self.at, skip)
        self.at.items.append(node)
        return node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in ("svg", "math") or (self._opaque() and self.at.tag in ("svg", "math")):  # there a slash closes
            return
        self.handle_starttag(tag, attrs)  # a slash on another element is ignored, as browsers do

    def handle_endtag(self, tag: str) -> None:
        if self._opaque():
            if tag == self.at.tag:
                self._close(self.at)
            elif tag in ("head", "article", "main") and (n := self._find((tag,))) is not None:
                self._close(n)
            return
        if tag == "a":
            self.link = None
        if (tag in BLOCKS or tag in self.inline) and (n := self._find((tag,))) is not None:
            self._close(n)

    def handle_data(self, data: str) -> None:
        if self.at.tag == "head" and data.strip():
            self._leave_head()
        if not self._opaque():
            self.at.items.append(data)
            n = len("".join(data.split()))
            self.at.chars += n
            if self.link is not None:
                self.at.link_chars += n

    def restore(self) -> None:
        """Keep marked elements that hold most of a text, and those around the longest
        articles (see above)."""
        if not self.named and not self.marks:
            return
        around = {}  # the skipped elements around each node
        size: dict = {}  # characters, without those of skipped elements but for marked ones
        todo = [(self.root, None)]
        order = []
        while todo:
            n, skipped = todo.pop()
            skipped = n if n.skip else skipped
            around[id(n)] = skipped
            order.append(n)
            todo.extend((c, skipped) for c in n.children())

        def measure(counts) -> None:
            for n in reversed(order):
                size[id(n)] = n.chars + sum(size[id(c)] for c in n.children() if counts(c))

        measure(lambda c: c.marked or not c.skip)
        titled = {id(p) for n in order if n.tag == "h1" for p in ancestors(n)}
        for n in self.marks:
            scope = next((p for p in ancestors(n) if p.tag in ("article", "main")), None)
            if scope is None and self.named:  # the text is the named elements'
                continue
            if 2 * size[id(n)] > size[id(scope or self.root)] or (scope is not None and id(n) in titled):
                n.skip = False
        measure(lambda c: not c.skip)
        clean = max((size[id(n)] for n in self.named if around[id(n)] is None), default=0)
        for n in self.named:
            if size[id(n)] > clean and around[id(n)] is not None:
                for p in (n, *ancestors(n)):
                    if p.skip and p.tag not in OPAQUE:
                        p.skip = False


def ancestors(n: Node) -> Iterator[Node]:
    while n.parent is not None:
        n = n.parent
        yield n


def in_order(root: Node) -> list[Node]:
    """Kept nodes, parents before children (no recursion: pages may nest deeply)."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo.extend(c for c in reversed(n.children()) if not c.skip)
    return out


def weigh(nodes: list[Node]) -> None:
    """Counts, densities and density sums, from the leaves up."""
    for n in reversed(nodes):
        if n.parent is not None:
            p = n.parent
            p.chars += n.chars
            p.tags += n.tags + 1
            p.link_chars += n.link_chars
            p.link_tags += n.link_tags
    body = nodes[0]
    ratio = body.link_chars / max(body.chars, 1)
    for n in nodes:
        if n.chars:
            c, lc, t, lt = n.chars, n.link_chars, max(n.tags + n.link_tags, 1), max(n.link_tags, 1)
            text = max(c - lc, 1)
            base = log(c / text * lc + ratio * c + e)
            n.density = max(0.0, c / t * log(c / max(lc, 1) * t / lt) / log(base) if base > 1 and c > 1 and log(base) > 0 else c / t)
    for n in nodes:
        n.total = sum(c.density for c in n.children() if not c.skip) or 0.0


def densest(nodes: list[Node]) -> Node:
    """The node with the greatest density sum; without any, the densest one."""
    return max(nodes, key=lambda n: (n.total, n.density))


def blocks_of(root: Node) -> list[str]:
    """Texts of the blocks under ``root`` in page order, white space folded."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        line = " ".join("".join(run).split())
        run.clear()
        if line:
            out.append(line)

    todo: list = [(root, 0)]
    while todo:
        node, k = todo.pop()
        while k < len(node.items):
            x = node.items[k]
            k += 1
            if isinstance(x, str):
                run.append(x)
            elif x.skip:
                run.append(" ") if x.tag not in BLOCKS else flush()
            else:
                flush()
                todo.append((node, k))
                todo.append((x, 0))
                break
        else:
            flush()
    return out


def linked(chars: int, link_chars: int, link_tags: int) -> bool:
    """Whether text is a menu or list of links: two links or more, most of its characters."""
    return link_tags > 1 and 2 * link_chars > chars


def holders(nodes: list[Node]) -> set[int]:
    """``id`` of the nodes that are such lists or hold one."""
    out: set[int] = set()
    for n in reversed(nodes):
        if linked(n.chars, n.link_chars, n.link_tags) or any(id(c) in out for c in n.children()):
            out.add(id(n))
    return out


def belongs(n: Node, lists: set[int], least: float) -> bool:
    """Whether a block beside the path is part of the text: no list of links, and, if it is
    a bare container, as dense as the path."""
    return not n.chars or (id(n) not in lists and (n.tag not in BARE or n.density >= least))


def whole(target: Node, path: list[Node], lists: set[int], bound: float) -> Node:
    """The subtree that is the article: the outermost ``article`` around ``target``, else the
    nearest ``main``, else the highest ancestor with nothing beside the path that does
    not belong to the text."""
    articles = [n for n in path if n.tag == "article"]
    mains = [n for n in path if n.tag == "main"]
    if articles or mains:
        return articles[-1] if articles else mains[0]
    top = target
    for p in path[1:]:
        kept = [c for c in p.children() if not c.skip]
        own = [getattr(p, f) - sum(getattr(c, f) for c in kept) for f in ("chars", "link_chars", "link_tags")]
        if linked(*own) or not all(belongs(c, lists, bound) for c in kept if c is not top):
            break
        top = p
    return top


def path_to_root(n: Node) -> list[Node]:
    return [n, *ancestors(n)]


def selected(nodes: list[Node]) -> list[Node]:
    """The article's subtree, and others that are articles as well, the page's title beside
    the path or reach the path's least density.  Each is taken whole."""
    target = densest(nodes)
    path = path_to_root(target)
    least, lists = min(x.density for x in path), holders(nodes)
    bound = min((x.density for x in path if id(x) not in lists), default=least)
    top = whole(target, path, lists, bound)
    chosen, todo = [], [(nodes[0], False)]
    on_path = set(map(id, path))
    while todo:
        n, below = todo.pop()  # below a subtree that is not taken only articles count
        kept = [c for c in reversed(n.children()) if not c.skip]
        if n is top:
            chosen.append(n)
        elif id(n) in on_path:
            todo.extend((c, False) for c in kept)
        elif n.chars and ((n.density >= (bound if n.tag in BARE else least) and not below) or (n.tag in (("article",) if below else ("article", "h1")) and not linked(n.chars, n.link_chars, n.link_tags))):
            chosen.append(n)
        else:
            todo.extend((c, True) for c in kept)
    return chosen


def extract(page: str | None) -> str:
    """Main text of one page."""
    if not page:
        return ""
    builder = TreeBuilder()
    builder.feed(page)
    builder.close()
    builder.restore()
    nodes = in_order(builder.root)
    weigh(nodes)
    return "\n".join(line for n in selected(nodes) for line in blocks_of(n))


def extract_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                p = b.slice(k, 256)
                texts = [extract(x.as_py()) for x in p.column(2)]
                yield pa.RecordBatch.from_arrays([p.column(0), p.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    slim = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    return slim.mapInArrow(run, "page_id long, url string, text string, n_chars long")
