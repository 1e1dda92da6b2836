"""Main text of HTML pages by tree scoring.

A page is read into a tree of its block elements. Each paragraph (a block that holds text itself) is worth points for its
length and its commas and passes them to its ancestors, half as much for each level up; a container's score is discounted
by its share of text inside links and weighed by what its tag, class, id and role say. The article or main element around
the best container (else the nearest one that is named as an article) is kept whole. Beside a best container that is no
article, siblings stay that are headings, paragraphs, lists, quotes or tables, or that score a fifth of it, unless they are
mostly links or a notice. What stands inside and is not article (menus, headers, footers, sidebars, notices, adverts, forms,
comments, scripts, styles) is left out before scoring.

Names are read word by word: `cookieBanner`, `cookie-banner` and `cookiebar` are the same mark. A mark decides about its
element, whatever else the name says (`comment-body`, `page-footer`); only header words yield to article words
(`post-header`), and names as layouts use them (`has-sidebar`) are no marks. An element that is marked by name but holds an
article or main element which is not marked is a wrapper and stays. Lines of tags, authors and teasers are left out where
most of their text is links.

Every step is linear in the page, however deep its elements nest: points go up and decisions go down in one pass each.

Text rules: character references are decoded, white space inside a block is one space, blocks are trimmed and joined by
one space in page order. Unclosed and stray tags are repaired as browsers do for blocks; an inline notice or advert without
an end tag ends with its block of text, or at once if it closes itself; a page that ends early is read as far as it goes.

Cases: null and empty html give the empty text, as does a page without article text; html without any block is one block.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import ready_workers

#: Elements whose content is not text of the page, and those that are read up to their end tag without markup.
RAW = frozenset(
    "script style textarea title noscript template iframe noframes noembed xmp svg canvas object select annotation".split()
)
#: Elements that are never part of an article.
OUTSIDE = frozenset("nav header footer aside form button menu dialog head fieldset input".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin a block of text.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table"
    " tbody td tfoot th thead tr ul".split()
)
#: What an open element is closed by: a new one of these.
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "thead": {"tr", "td", "th", "thead", "tbody", "tfoot"},
    "tbody": {"tr", "td", "th", "thead", "tbody", "tfoot"},
    "tfoot": {"tr", "td", "th", "thead", "tbody", "tfoot"},
    "body": {"head"},
}
#: Elements that end the search for what a new element closes.
SCOPE = {
    "li": {"ul", "ol", "menu", "dir"},
    "dt": {"dl"},
    "dd": {"dl"},
    "tr": {"table"},
    "td": {"table"},
    "th": {"table"},
    "thead": {"table"},
    "tbody": {"table"},
    "tfoot": {"table"},
    "body": set(),
}
#: Words in class, id or role that tell boilerplate.
BOILERPLATE = frozenset(
    "ad ads advert advertisement advertising adverts sponsor sponsored promo promoted promotion banner nav navbar navigation"
    " navi menu menubar breadcrumb breadcrumbs sidebar side aside complementary footer foot bottombar header masthead topbar"
    " toolbar cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe"
    " subscription signup login share sharing social comment comments commentlist reply replies discussion disqus respond"
    " related recommended recommendations widget pagination pager search contentinfo skip hidden disclaimer copyright"
    " outbrain taboola".split()
)
#: Those that an article word beside them in the same name takes back: the head of a post is part of it.
HEADER = frozenset("header masthead topbar banner side".split())
#: Words that mark even an article element: comments and adverts are often marked up as articles.
ALIEN = frozenset(
    "ad ads advert advertisement adverts sponsor sponsored promo promoted comment comments commentlist reply replies related"
    " recommended recommendations".split()
)
#: Words of lines about an article, which are left out if they are mostly links.
ABOUT = frozenset("tags teaser meta byline".split())
#: Beginnings and endings of words that are written together with others.
JOINED_START = ("comment", "cookie", "advert", "adbox", "adslot", "adunit", "adbanner", "sponsor", "newsletter", "breadcrumb", "sidebar")
JOINED_END = ("comment", "comments", "menu", "footer", "sidebar", "navbar", "banner", "advert", "adverts")
#: Words before a mark by which a layout says that it has or lacks something.
LAYOUT = frozenset("has with without no not js is hide".split())
#: Words that tell an article.
ARTICLE = frozenset("article content main body post entry story text page blog hentry maincontent".split())
#: How notices begin that carry no mark.
NOTICE = re.compile(
    r"(?:we|this (?:web)?site|our (?:web)?site) uses? cookies|(?:copyright|\(c\)|©)\W*(?:\d{4}|\w+ \d{4}|©)|all rights reserved|accept (?:all )?cookies",
    re.IGNORECASE,
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks that are paragraphs themselves and no containers.
PARAGRAPH = HEADING | {"p", "pre", "li", "dt", "dd"}
#: Siblings of a best container that need no score of their own.
BESIDE = HEADING | {"p", "pre", "ul", "ol", "dl", "blockquote", "table", "figure"}
#: Worth of a tag as a container before its paragraphs count.
WORTH = {"article": 30.0, "main": 25.0, "section": 8.0, "div": 5.0, "td": 3.0, "blockquote": 3.0, "pre": 3.0}

_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</[^>a-zA-Z][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[A-Z]*[a-z]+|[A-Z]+|[0-9]+")
_SPACE = re.compile(r"[ \t\n\f\r\x0b]+")


@dataclass(eq=False)
class Node:
    tag: str
    parent: Node | None
    depth: int
    #: Never part of an article because of its tag or place; marked as boilerplate by its name; a line about the article.
    outside: bool = False
    marked: bool = False
    about: bool = False
    weight: float = 0.0
    children: list[Node] = field(default_factory=list)
    score: float = 0.0
    direct: float = 0.0
    chars: int = 0
    linked: int = 0


@dataclass
class Marks:
    """What class, id, role and hidden say about an element."""

    hidden: bool = False
    marked: bool = False
    alien: bool = False
    about: bool = False
    weight: float = 0.0


def _words(name: str) -> list[str]:
    """The words of one name, lower-cased; a capital begins a word, and joined words yield their known part too."""
    out = []
    for w in _WORD.findall(name):
        w = w.lower()
        out.append(w)
        if w not in BOILERPLATE:
            out += [p for p in JOINED_START if w.startswith(p)][:1] or [p for p in JOINED_END if w.endswith(p)][:1]
    return ["ad" if w in ("adbox", "adslot", "adunit", "adbanner") else w for w in out]


def _marks(attributes: str) -> Marks:
    out = Marks()
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            out.hidden = True
        elif name == "style" and "display:none" in value.lower().replace(" ", ""):
            out.hidden = True
        elif name in ("class", "id", "role"):
            for one in references.unescape(value).split():
                words = _words(one)
                known = set(words)
                if words and words[0] in LAYOUT:
                    continue
                article = bool(known & ARTICLE)
                told = known & BOILERPLATE - (HEADER if article else frozenset()) or {
                    w for w in known if w in ("advert", "sponsor", "cookie", "comment", "breadcrumb")
                }
                out.marked = out.marked or bool(told)
                out.alien = out.alien or bool(told & ALIEN)
                out.about = out.about or bool(known & ABOUT)
                out.weight += (15.0 if article else 0.0) - (15.0 if known & BOILERPLATE else 0.0)
    return out


def _hides(attributes: str) -> bool:
    marks = _marks(attributes)
    return marks.hidden or marks.marked


class Page:
    """Tree of blocks, and the pieces of text in page order as (node, text, inside a link, block)."""

    def __init__(self, html: str):
        self.root = Node("html", None, 0)
        #: All nodes, parents before children; the open ones from the root on; and for each tag the depths of those.
        self.nodes = [self.root]
        self.path = [self.root]
        self.depths: dict[str, list[int]] = {}
        self.pieces: list[tuple[Node, str, bool, int]] = []
        self.block = 0
        self.links = 0
        self._read(html)
        self._settle()

    @property
    def node(self) -> Node:
        return self.path[-1]

    def _depth(self, tag: str) -> int:
        """Of the innermost open element of that name; the root's where there is none."""
        found = self.depths.get(tag)
        return found[-1] if found else 0

    def _close_to(self, depth: int) -> None:
        """Close what is open at that depth and below."""
        while len(self.path) > max(depth, 1):
            self.depths[self.path.pop().tag].pop()

    def _open(self, tag: str, attributes: str) -> None:
        marks = _marks(attributes) if attributes.strip() else Marks()
        if tag in ("html", "body"):
            self.node.weight += marks.weight
            if tag == "body" and self._depth("head"):
                self._close_to(self._depth("head"))
            return
        if tag != "button":
            self._close_paragraph()
        closes = CLOSES.get(tag)
        if closes:
            scope = max((self._depth(t) for t in SCOPE[tag]), default=0)
            # The outermost of those inside the scope: all that are passed on the way get closed.
            out = 0
            for t in closes:
                for depth in reversed(self.depths.get(t, ())):
                    if depth <= scope:
                        break
                    out = min(out or depth, depth)
            if out:
                self._close_to(out)
        own = tag in ("article", "main")
        node = Node(
            tag, self.node, len(self.path), marks.hidden or tag in OUTSIDE, marks.alien if own else marks.marked,
            marks.about, marks.weight,
        )
        self.node.children.append(node)
        self.nodes.append(node)
        self.block += 1
        self.links = 0
        if tag not in VOID:
            self.depths.setdefault(tag, []).append(len(self.path))
            self.path.append(node)

    def _close_paragraph(self) -> None:
        if self.node.tag == "p":
            self._close_to(self.node.depth)

    def _end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        depth = self._depth(tag)
        if tag in ("p", "li") and max(map(self._depth, ("div", "article", "section", "table", "main"))) > depth:
            return
        if depth:
            self._close_to(depth)
        self.block += 1
        self.links = 0

    def _settle(self) -> None:
        """Marks that hold an unmarked article are wrappers; then everything inside what is left out is left out."""
        holds: set[int] = set()
        for node in reversed(self.nodes):
            if id(node) in holds or node.tag in ("article", "main") and not node.marked and not node.outside:
                node.marked = False
                if node.parent is not None:
                    holds.add(id(node.parent))
        for node in self.nodes:
            node.outside = node.outside or node.marked or (node.parent is not None and node.parent.outside)

    def _text(self, text: str) -> None:
        if text:
            self.pieces.append((self.node, text, self.links > 0, self.block))

    def _within(self, node: Node) -> bool:
        """Whether a block is still open."""
        return node.depth < len(self.path) and self.path[node.depth] is node

    def _hide(self, piece: int, block: int) -> None:
        """Take out what an inline element without an end tag hides: the rest of the text of its own block."""
        end = piece
        while end < len(self.pieces) and self.pieces[end][3] == block:
            end += 1
        del self.pieces[piece:end]

    def _read(self, html: str) -> None:
        # hidden: an open inline element that hides its content and the elements of its name inside, each as (tag, the block
        # it stands in); first: the piece and block of text that the outermost begins with.
        at, hidden, first = 0, [], (0, 0)
        while True:
            m = _TAG.search(html, at)
            text = references.unescape(html[at : m.start() if m else len(html)])
            self._text(text)
            if m is None:
                if hidden:
                    self._hide(*first)
                return
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            closing = m[1] == "/"
            if tag in RAW and not closing:
                if m[3].rstrip().endswith("/") and tag in ("svg", "math"):
                    continue
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
                at = end.end() if end else len(html)
            elif tag in BLOCK:
                if tag == "hr":
                    self._close_paragraph()
                    self.block += 1
                elif closing:
                    self._end(tag)
                else:
                    self._open(tag, m[3])
                # What is still open in a block that has ended ends with it.
                while hidden and not self._within(hidden[-1][1]):
                    hidden.pop()
                    if not hidden:
                        self._hide(*first)
            elif tag == "br":
                self._text(" ")
            elif tag == "a":
                self.links = 0 if closing else 1
            elif closing:
                if hidden and tag == hidden[-1][0]:
                    hidden.pop()
                    if not hidden:
                        del self.pieces[first[0] :]
            elif m[3].rstrip().endswith("/"):
                continue
            elif hidden and tag == hidden[-1][0]:
                hidden.append((tag, self.node))
            elif tag not in VOID and not hidden and m[3].strip() and _hides(m[3]):
                hidden.append((tag, self.node))
                first = (len(self.pieces), self.block)

    def blocks(self) -> list[tuple[Node, str, int]]:
        """The blocks of text: their node, text and number of characters inside links."""
        out: list[tuple[Node, str, int]] = []
        now, parts, linked = None, [], 0

        def close() -> None:
            text = _SPACE.sub(" ", "".join(parts)).strip(" ")
            if text:
                out.append((now[0], text, min(linked, len(text))))

        for node, text, link, block in self.pieces:
            if node.outside:
                continue
            if now is not None and (block != now[1] or node is not now[0]):
                close()
                parts, linked = [], 0
            now = (node, block)
            parts.append(text)
            linked += len(text) if link else 0
        if now is not None:
            close()
        return out


def container(best: Node) -> Node:
    """The outermost article or main element around a node, else the nearest that is named as an article, else the node."""
    around, at = [], best
    while at.parent is not None:
        around.append(at)
        at = at.parent
    whole = [n for n in around if n.tag in ("article", "main")]
    named = [n for n in around if n.weight > 0 and n.chars]
    return whole[-1] if whole else named[0] if named else best


def main_text(html: str | None) -> str:
    """The article of a page as plain text."""
    if not html:
        return ""
    page = Page(html)
    blocks = page.blocks()
    for node, text, linked in blocks:
        node.direct += (1.0 + text.count(",") + text.count("，") + min(len(text) / 100.0, 3.0)) * (1.0 - linked / len(text))
        node.chars += len(text)
        node.linked += linked
    # Bottom-up: a paragraph hands its points to its container whole, a container half of its score.
    for node in reversed(page.nodes):
        # Lines about the article that are mostly links take no part.
        if node.about and 2 * node.linked > node.chars:
            node.outside, node.chars, node.linked, node.score, node.direct = True, 0, 0, 0.0, 0.0
        paragraph = node.tag in PARAGRAPH
        if not paragraph:
            node.score += node.direct
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
            node.parent.score += (node.direct if paragraph else 0.0) + node.score / 2.0
    for node in page.nodes:
        node.outside = node.outside or node.parent is not None and node.parent.outside
    touched = [n for n in page.nodes if n.chars and not n.outside]
    if not touched:
        return ""

    def worth(n: Node) -> float:
        if not n.chars:
            return 0.0
        return (n.score + (WORTH.get(n.tag, 0.0) + n.weight if n.score else 0.0)) * (1.0 - n.linked / n.chars)

    best = max(touched, key=lambda n: (worth(n), -n.depth))
    # A paragraph is no container.
    while best.parent is not None and best.parent.chars and best.tag in PARAGRAPH | {"td", "tr"}:
        best = best.parent
    best = container(best)
    kept = {id(best)}
    if best.parent is not None:
        kept |= {id(n) for n in _beside(best, worth, {id(node): text for node, text, _ in reversed(blocks)})}
    # Top-down: what is kept is kept with all that is in it.
    inside: dict[int, bool] = {}
    for node in page.nodes:
        above = node.parent is not None and inside[id(node.parent)] and node.parent is not best.parent
        inside[id(node)] = not node.outside and (above or id(node) in kept)
    return " ".join(text for node, text, _ in blocks if inside[id(node)])


def _beside(best: Node, worth: Callable[[Node], float], first: dict[int, str]) -> Iterator[Node]:
    """What stands beside the best container and belongs to it; the parent itself stands for its loose text."""
    least, whole = max(10.0, 0.2 * worth(best)), best.tag in ("article", "main")
    for node in [best.parent, *best.parent.children]:
        if node is best or not node.chars or NOTICE.match(first.get(id(node), "")):
            continue
        if node is best.parent:
            if not whole:
                yield node
        elif 2 * node.linked <= node.chars and (
            node.tag in HEADING
            or (node.tag == best.tag if whole else node.tag in BESIDE or worth(node) >= least)
        ):
            yield node


def extract(html: Column) -> Column:
    """The main text of a column of pages."""

    def work(column: pa.Array) -> pa.Array:
        return pa.array([main_text(h) for h in column.to_pylist()], pa.string())

    return F.arrow_udf(work, "string")(html)


def extracted_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    ready_workers(pages.sparkSession)
    return pages.select("page_id", "url", extract(F.col("html")).alias("text")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )
