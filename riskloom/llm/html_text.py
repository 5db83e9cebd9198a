"""Main text of web pages by composite text density.

The markup becomes a tree of elements (unclosed and crossed tags are closed as browsers do in the common cases). What is
boilerplate by its element, role, class or id goes first. For every node that is left, with C characters, T tags, LC
characters and LT tags of links, the density is

    C / T * log_b(C / LC * T / LT),  b = ln(C / (C - LC) * LC + LC_body / C_body * C + e),

zero divisors counting as 1. The sum of a node's child densities is its score, and the node with the largest sum is the
core. The least density on the path from the body to the core is the threshold: where the path passes, other
children that reach it belong to the text too, unless they are mostly links. A core inside a ``main`` or else ``article`` stands
for the outermost such element, one that is a single paragraph for the element around it. All other ``article``
elements belong to the text unless their role, class or id marks them as boilerplate. Inside the chosen elements only what is
marked is dropped; where the whole body is the core, lists of links are too. A class or id marks an element if all its
words are names of boilerplate or shape them (``share-buttons``, not ``related-work``); headings, paragraphs and other
running text are marked only by a class that is such a name by itself.

Blocks are the texts between block-level tags: character references decoded, white space as one blank, trimmed, joined
by two line ends. Defined results: null and empty pages and pages without text give an empty text; null ids and urls are
passed on; repeated rows are extracted each; extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe noframes textarea title svg object canvas audio video".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
BOILERPLATE = set("nav header footer aside form button select menu dialog head annotation annotation-xml".split())
ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
NAMES = set(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads advert adverts advertisement advertising adbox sponsor sponsored promo "
    "promotion banner cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup comment "
    "comments commentlist disqus respond replies social share sharing related recommended breadcrumb breadcrumbs pagination pager widget toolbar "
    "login search skip form".split()
)
#: Names that an article's own title or text may have too: they say little on a heading or beside a word of ``OWN``.
TITLES = set("header masthead banner form search notice alert".split())
OWN = set("article blog content entry main page post site story text body".split())
#: Words that only shape what a name beside them says.
SHAPES = set(
    "area bar block bottom box btn button buttons center column container content feed global group icon icons inline inner item items left links "
    "list main module news outer page panel policy post posts primary region right secondary section site slot stories story thread top unit "
    "widget widgets wrap wrapper article articles blog entry".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Elements of running text: an id is only a place to link to, and a class counts if it is a name by itself.
RUNNING = HEADINGS | set("p span em strong b i u s a code kbd pre blockquote q cite mark small sub sup abbr time label dt dd li td th tr caption figcaption font".split())
#: What a start tag closes: itself and these, up to the elements that bound them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
_BOUNDS = {"td", "th", "table", "body", "html"}
_TAG = re.compile(r"<!--|<[!?]|<(/?)([a-zA-Z][^\s/>]*)")
_NAME = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_FOR = re.compile(r"(?<![\w-])for\s*=", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_BLANK = re.compile(r"\s+")
_INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "parts", "parent", "drop", "marked", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, drop: bool = False, marked: bool = False):
        self.tag, self.parent, self.drop, self.marked, self.parts = tag, parent, drop, marked, []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _attributes(page: str, at: int) -> tuple[str, int]:
    """The attribute text from ``at`` and the place after the tag's end; a ``>`` in quotes is no end."""
    end = page.find(">", at)
    if end < 0:
        return page[at:], len(page)
    text = page[at:end]
    for quote in ('"', "'"):
        if text.count(quote) % 2 and "=" + quote in text.replace(" ", ""):
            close = page.find(quote, end)
            later = page.find(">", close) if close >= 0 else -1
            if 0 <= later and "<" not in page[end:close]:
                return page[at:later], later + 1
    return text, end + 1


def _named(tag: str, attribute: str, value: str) -> bool:
    """Whether a class or id names boilerplate: a class by itself, or a compound of names and words that shape them."""
    names = NAMES - TITLES if tag in HEADINGS else NAMES
    if tag in RUNNING:
        return attribute == "class" and not names.isdisjoint(value.split())
    for whole in value.split():
        parts = [w for w in _SPLIT.split(whole) if w and not w.isdigit()]
        found = NAMES.intersection(parts)
        if found and all(w in NAMES or w in SHAPES for w in parts) and not (found <= TITLES and OWN & set(parts) - {"site", "page", "main"}):
            return True
    return False


def _is_boilerplate(tag: str, attributes: str) -> bool:
    if tag in BOILERPLATE or (tag == "label" and _FOR.search(attributes)):
        return True
    if tag in ("html", "body", "article", "main") or not attributes.strip():
        return False
    for name, *values in _NAME.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and _INVISIBLE.search(value)):
            return True
        if name == "role" and value.strip() in ROLES or name in ("class", "id") and _named(tag, name, value):
            return True
    return False


def parse(page: str) -> Node:
    """The tree of a page; texts stand among the children as strings, still with character references."""
    root = node = Node("html", None)
    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if not m:
            node.parts.append(page[at:])
            break
        if m.start() > at:
            node.parts.append(page[at : m.start()])
        if m[0] == "<!--":
            close = page.find("-->", m.end())
            at = close + 3 if close >= 0 else end
            continue
        if not m[2]:
            close = page.find(">", m.end())
            at = close + 1 if close >= 0 else end
            continue
        tag = m[2].lower()
        attributes, at = _attributes(page, m.end())
        if m[1]:
            place = node
            while place is not None and place.tag != tag:
                place = place.parent
            if place is not None and place.parent is not None:
                node = place.parent
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b", re.I).search(page, at)
            at = page.find(">", close.end()) + 1 or end if close else end
            node.parts.append(" ")
            continue
        if tag in VOID:
            if tag == "input" and node.tag == "label":
                node.drop = True
            node.parts.append(Node(tag, node))
            continue
        if tag == "html" or (tag == "body" and node is not root and any(isinstance(x, Node) and x.tag == "body" for x in root.parts)):
            continue
        if tag in BLOCK:
            place = node
            while place is not None and place.tag != "p" and place.tag not in _BOUNDS and place.tag not in ("article", "section", "div", "main"):
                place = place.parent
            if place is not None and place.tag == "p":
                node = place.parent
        if tag in CLOSES:
            own, bounds = CLOSES[tag]
            place = node
            while place is not None and place.tag not in own and place.tag not in bounds:
                place = place.parent
            if place is not None and place.tag in own:
                node = place.parent
        if tag == "body" and node.tag == "head":
            node = node.parent
        child = Node(tag, node, _is_boilerplate(tag, attributes), tag == "article" and _is_boilerplate("div", attributes))
        node.parts.append(child)
        if not (attributes.endswith("/") and tag not in BLOCK):
            node = child
    return root


def _children(node: Node) -> list[Node]:
    return [x for x in node.parts if isinstance(x, Node) and not x.drop]


def _ordered(root: Node) -> list[Node]:
    """All nodes that are not dropped, parents first."""
    out = [root]
    for node in out:
        out.extend(_children(node))
    return out


def _spare_articles(root: Node) -> None:
    """A class or id never drops an element around an article or main text."""
    waiting = [root]
    while waiting:
        node = waiting.pop()
        if node.tag in ("article", "main"):
            up = node.parent
            while up is not None:
                if up.tag not in BOILERPLATE:
                    up.drop = False
                up = up.parent
        waiting.extend(x for x in node.parts if isinstance(x, Node))


def measure(nodes: list[Node]) -> None:
    """Counts, densities and density sums; ``nodes`` has parents first."""
    for node in reversed(nodes):
        own = sum(len(_BLANK.sub(" ", html.unescape(x)).strip()) for x in node.parts if isinstance(x, str) and not x.isspace())
        below = _children(node)
        node.chars = own + sum(x.chars for x in below)
        node.tags = sum(x.tags + 1 for x in below)
        link = node.tag == "a"
        node.link_chars = node.chars if link else sum(x.link_chars for x in below)
        node.link_tags = link + sum(x.link_tags for x in below)
    body = nodes[0]
    share = body.link_chars / max(body.chars, 1)
    for node in reversed(nodes):
        c, t, lc, lt = node.chars, max(node.tags, 1), node.link_chars, node.link_tags
        if c:
            base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
            node.density = c / t * math.log(max(c / max(lc, 1) * t / max(lt, 1), 1.0)) / max(math.log(base), 1.0) if base > 1 else c / t
        node.total = sum(x.density for x in _children(node))


def _is_link_list(node: Node) -> bool:
    return node.tag in ("ul", "ol", "div", "table", "p", "section") and node.link_tags >= 2 and 2 * node.link_chars > node.chars


def _text(node: Node, out: list[str], link_lists: bool = True) -> None:
    """The parts of a node in page order, a line end at each block border."""
    waiting: list = [node]
    while waiting:
        x = waiting.pop()
        if isinstance(x, str):
            out.append(x)
        elif x.tag in ("br", "hr"):
            out.append(" " if x.tag == "br" else "\0")
        elif not x.drop and (link_lists or x is node or not _is_link_list(x)):
            border = ["\0"] if x.tag in BLOCK else []
            waiting.extend(border + x.parts[::-1] + border)


def extract(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page.replace("\0", "�"))
    _spare_articles(root)
    nodes = _ordered(root)
    measure(nodes)
    if not root.chars:
        return ""
    core = max(nodes, key=lambda n: (n.total, n.density))
    if not core.total:
        core = max(nodes, key=lambda n: n.density)
    path = [core]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    whole = [n for n in path if n.tag == "main"] or [n for n in path if n.tag == "article"]
    if whole:
        core = whole[-1]
    while not whole and core.parent is not None and core.tag not in ("div", "section", "body", "td", "html"):
        core = core.parent
    on_path, around, out = set(map(id, path)), set(), []
    for node in nodes:
        up = node.parent if node.tag == "article" and not node.marked else None
        while up is not None and id(up) not in around:
            around.add(id(up))
            up = up.parent
    waiting: list = [root]
    while waiting:
        x = waiting.pop()
        if isinstance(x, str):
            out.append(x)
        elif x is core:
            out.append("\0")
            _text(x, out, core.tag not in ("body", "html"))
            out.append("\0")
        elif id(x) in on_path:
            waiting.extend(["\0", *x.parts[::-1], "\0"])
        elif not x.drop and not x.marked and (x.tag in ("article", "main") or (x.density >= threshold and not _is_link_list(x))):
            out.append("\0" if x.tag in BLOCK else "")
            _text(x, out)
            out.append("\0" if x.tag in BLOCK else "")
        elif not x.drop and id(x) in around:
            waiting.extend(["\0", *_children(x)[::-1], "\0"])
        else:
            out.append("\0" if x.tag in BLOCK else " ")
    blocks = (_BLANK.sub(" ", html.unescape(b)).strip() for b in "".join(out).split("\0"))
    return "\n\n".join(b for b in blocks if b)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    given = pages.select("page_id", "url", F.col("html").cast("string"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(v.as_py()) for v in batch["html"]]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    key, url = (given.schema[c].dataType.simpleString() for c in ("page_id", "url"))
    return given.mapInArrow(step, f"page_id {key}, url {url}, text string, n_chars long")
