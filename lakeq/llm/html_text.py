"""HTML extraction by composite text density.

A page is parsed into a DOM. For every node with C characters, T tags, LC link
characters and LT link tags below it, the composite density is

    C / T * log base B of (C / LC * T / LT),  B = ln(C / nLC * LC + LCb / Cb * C + e)

(nLC: characters outside links; LCb, Cb: those of the body; counts of zero are
taken as one). Text that is long per tag and free of links scores high, menus low.
The densities of a node's block children, and that of text directly in it, add up
to its density sum, and the subtree with the largest sum is selected. The threshold
is the least density on its path from the body.

* In a ``main`` of several articles, the whole ``main`` is taken.
* In an ``article``, that is taken; without ``main``, with what reaches the threshold
  of the page's other articles.
* In a ``main`` without an article around the subtree, the whole ``main`` is taken.
* Else the subtree is taken with what reaches the threshold beside its path, up to and
  with the children of the body: whole blocks, of blocks below the threshold the
  blocks in them, and the text between blocks.

Subtrees whose tag, role or class says that they are no part of an article (menus,
headers, footers, sidebars, notices, adverts, forms, scripts, comments) are left out
of the counts and of the text.

Pages are independent, so this is one map over the whole table, without a shuffle.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from lakeq.llm.common import text_batches

# The HTML standard's element sets.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data dfn em font i img ins kbd label mark q ruby rb rp rt rtc s samp "
    "small span strike strong sub sup time tt u var wbr".split())
P_CLOSERS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
# A start tag closes an open element of these names, up to the named boundary.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
            "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"})}
SCOPES = frozenset("article aside body div footer header html main nav section table td th ul ol form".split())

NOT_TEXT = frozenset(
    "head script style noscript template iframe object embed svg canvas audio video nav footer aside form button "
    "select option input textarea dialog menu".split())
NOT_ROLE = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
_NOT_WORD = (
    "ad|ads|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|banner|nav|navbar|"
    "navigation|menu|breadcrumb|breadcrumbs|sidebar|side|aside|widget|footer|masthead|comment|comments|commentlist|"
    "disqus|reply|replies|respond|cookie|cookies|consent|notice|notices|alert|popup|modal|newsletter|subscribe|signup|"
    "share|sharing|social|related|recommended|pagination|pager|toolbar|login|search")
NOT_CLASS = re.compile(rf"(?:^|[\s_-])(?:{_NOT_WORD})(?:$|[\s_-])")
# Within an article ids are often made of its headings: only a whole id counts, and none of a heading.
NOT_ID = re.compile(rf"\s*(?:{_NOT_WORD})\s*")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# An id that names a list of comments; one with the word elsewhere may be a heading's, so its content tells.
COMMENTS = re.compile(r"(?:.*[\s_-])?(?:comments?|commentlist|disqus|repl(?:y|ies)|responses?)"
                      r"(?:[\s_-](?:area|block|box|container|form|list|section|thread|wrap|wrapper))*\s*")
COMMENT_WORD = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|repl(?:y|ies)|responses?)(?:$|[\s_-])")
# Words of a class that tell for inline elements and paragraphs only when they are a whole class.
TEXT_BLOCKS = HEADINGS | frozenset("p li dt dd td th blockquote caption figcaption pre".split())
NOT_TOKEN = re.compile(rf"(?:^|\s)(?:{_NOT_WORD})(?:$|\s)")

# Quotes hold a value only after an equals sign; elsewhere they are characters like others.
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')|=)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)


class Node:
    __slots__ = ("tag", "parent", "children", "skip", "chars", "tags", "link_chars", "link_tags", "density", "sum",
                 "inside", "scope", "block")

    def __init__(self, tag: str, parent: Node | None, skip: bool):
        self.tag, self.parent, self.children, self.skip = tag, parent, [], skip
        # Within an article or main; the open elements of the nearest scope; the nearest block.
        self.inside = tag in ("article", "main") or parent is not None and parent.inside
        self.scope = Counter() if parent is None or tag in SCOPES else parent.scope
        self.block = tag if parent is None or tag not in INLINE else parent.block
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


def _excluded(tag: str, attributes: str, here: Node) -> bool | None:
    """Does an element below ``here`` hold no content? None: its content tells."""
    in_article = here.inside
    if tag in NOT_TEXT or tag == "header" and not in_article:
        return True
    doubt = False
    for name, *value in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(value).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value in NOT_ROLE:
            return True
        if name == "id" and in_article:
            if tag in HEADINGS or tag in ("article", "main"):
                continue
            if NOT_ID.fullmatch(value) or COMMENTS.fullmatch(value):
                return True
            doubt = doubt or tag not in INLINE and COMMENT_WORD.search(value) is not None
        elif name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            if in_article and tag in INLINE and here.block in TEXT_BLOCKS:
                continue  # a word or link of a sentence
            if (NOT_TOKEN if in_article and tag in TEXT_BLOCKS else NOT_CLASS).search(value):
                return True
    return None if doubt else False


def _is_thread(section: Node) -> bool:
    """Does a section look like readers' comments: two or more dates, authors, entries or fields to fill in?"""
    signs, stack = 0, [section]
    while stack and signs < 2:
        for c in stack.pop().children:
            if isinstance(c, Node):
                signs += c.tag in ("time", "article", "form", "textarea", "button", "cite", "footer", "li")
                stack.append(c)
    return signs >= 2


def parse(page: str) -> Node:
    """The DOM below an implied body; unclosed and misnested tags end as in browsers.
    Counts of open elements, of the page and of each scope, tell when there is nothing
    to close, so that no tag looks through all open elements in vain."""
    root = Node("body", None, False)
    here, at, size = root, 0, len(page)
    open_, doubts = Counter(), []

    def text(s: str) -> None:
        if not here.skip and s:
            here.children.append(s)

    def leave(node: Node) -> None:
        """Close ``node`` and all that is open in it."""
        nonlocal here
        while True:
            last, here = here, here.parent
            open_[last.tag] -= 1
            if last.tag not in SCOPES:
                last.scope[last.tag] -= 1
            if last is node:
                return

    def close(names: set[str] | frozenset[str], stop: set[str] | frozenset[str]) -> None:
        """Close the outermost open element of ``names`` before ``stop``."""
        node, found = here, None
        while node is not root and node.tag not in stop:
            if node.tag in names:
                found = node
            node = node.parent
        if found:
            leave(found)

    while at < size:
        m = _TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:  # an end tag closes its element and all that is open in it
            # An inline element does not end beyond its block.
            if open_[tag] if tag in SCOPES else here.scope[tag]:
                node = here
                while node.tag != tag:
                    node = node.parent
                leave(node)
            continue
        if tag in ("html", "body"):
            continue
        if here.tag == "head" and tag in P_CLOSERS:
            leave(here)
        if tag in P_CLOSERS and here.scope["p"]:
            close({"p"}, SCOPES)
        if tag in SIBLINGS and any(open_[t] for t in SIBLINGS[tag][0]):
            close(*SIBLINGS[tag])
        excluded = not here.skip and _excluded(tag, m[3], here)
        node = Node(tag, here, here.skip or bool(excluded))
        if excluded is None:
            doubts.append(node)
        here.children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            if tag not in NOT_TEXT and not node.skip and tag != "title":
                node.children.append(page[at:end.start() if end else size])
            at = end.end() if end else size
        elif tag not in VOID and not m[3].rstrip().endswith("/") or tag == "p":
            here = node
            open_[tag] += 1
            if tag not in SCOPES:
                node.scope[tag] += 1
    for node in doubts:
        node.skip = _is_thread(node)
    return root


def _add(node: Node) -> None:
    """Characters and tags of a node whose children have theirs."""
    for c in node.children:
        if isinstance(c, str):
            node.chars += sum(map(len, c.split()))
        elif not c.skip:
            node.chars += c.chars
            node.tags += c.tags + 1
            node.link_chars += c.chars if c.tag == "a" else c.link_chars
            node.link_tags += c.link_tags + (c.tag == "a")


def _weigh(node: Node, root: Node) -> None:
    """Composite density of a counted node."""
    if node.chars:
        body_links, body_chars = max(root.link_chars, 1), max(root.chars, 1)
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        base = math.log(c / max(c - node.link_chars, 1) * node.link_chars + body_links / body_chars * c + math.e)
        node.density = c / t * max(math.log(c / lc * t / lt) / math.log(max(base, 1.0001)), 0.0)


def _count(root: Node) -> list[Node]:
    """Counts, density and density sum of every node, children before parents."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if isinstance(c, Node) and not c.skip]
    order.reverse()
    for node in order:
        _add(node)
    for node in order:
        _weigh(node, root)
        own = sum(sum(map(len, c.split())) for c in node.children if isinstance(c, str))
        node.sum = float(own) if node.tag in INLINE else 0.0
        for c in node.children:
            if isinstance(c, Node) and not c.skip:
                node.sum += c.sum if c.tag in INLINE else c.density
        if own and node.tag not in INLINE:
            node.sum += own / (1 + node.tags)
    return order


def _parts(children: list[Node | str], root: Node) -> list[Node]:
    """The blocks among ``children``, and each run of text and inline elements between
    them as a node without a name."""
    parts = []
    for c in children:
        if isinstance(c, str) or c.tag in INLINE:
            if not parts or parts[-1].tag:
                parts.append(Node("", None, False))
            parts[-1].children.append(c)
        elif not c.skip:
            parts.append(c)
    for node in parts:
        if not node.tag:
            _add(node)
            _weigh(node, root)
    return parts


def _reaching(parts: list[Node], threshold: float, root: Node) -> list[Node]:
    """What reaches the threshold in ``parts``, in page order: of blocks below it, parts of them."""
    found, stack = [], parts[::-1]
    while stack:
        node = stack.pop()
        if node.density >= threshold:
            found.append(node)
        elif node.tag:
            stack += _parts(node.children, root)[::-1]
    return found


def _articles(node: Node) -> list[Node]:
    """The outermost articles below a node, in page order."""
    found, stack = [], [node]
    while stack:
        n = stack.pop()
        if n.tag == "article":
            found.append(n)
        else:
            stack += [c for c in reversed(n.children) if isinstance(c, Node) and not c.skip]
    return found


def content(root: Node) -> list[Node]:
    """The subtrees that hold the main text, in page order (see the module)."""
    order = _count(root)
    # Children come before parents in `order`: of equal sums the outermost counts.
    best = root
    for node in reversed(order):
        if node.sum > best.sum and node.tag not in INLINE:
            best = node
    path = [best]
    while path[-1] is not root:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    main = next((n for n in reversed(path) if n.tag == "main"), None)
    article = next((n for n in reversed(path) if n.tag == "article"), None)
    if main and (not article or len(_articles(main)) > 1):
        return [main]
    if article:
        return [article] if main else [n for a in _articles(root)
                                       for n in ([a] if a is article else _reaching([a], threshold, root)) if n.chars]
    before, after = [], []
    for above, below in zip(path[1:], path):
        at = above.children.index(below)
        before.append(_reaching(_parts(above.children[:at], root), threshold, root))
        after += _reaching(_parts(above.children[at + 1:], root), threshold, root)
    chosen = [n for found in reversed(before) for n in found] + [best] + after
    return [n for n in chosen if n.chars]


def blocks(node: Node) -> list[str]:
    """Text blocks below a node: character references decoded, white space joined."""
    out: list[list[str]] = [[]]
    stack: list = [node]
    while stack:
        n = stack.pop()
        if n is None:
            out.append([])
        elif isinstance(n, str):
            out[-1].append(n)
        elif not n.skip:
            if n.tag == "br":
                out[-1].append(" ")
                continue
            edge = [] if n.tag in INLINE else [None]
            stack += edge + n.children[::-1] + edge
    texts = (" ".join(html.unescape("".join(b)).split()) for b in out)
    return [t for t in texts if t]


def main_text(page: str | None) -> str:
    """The main text of a page, blocks joined by an empty line."""
    if not page:
        return ""
    root = parse(page)
    return "\n\n".join(b for n in content(root) for b in blocks(n))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    Edge cases: null or empty pages, and pages without any text outside the parts
    left out, have an empty text; plain text without markup is one block; broken
    markup never fails; repeated rows are extracted alike; other columns are not
    read; an empty table gives an empty result.
    """
    text_batches(pages.sparkSession)
    thin = pages.select(id_col, url_col, html_col)
    types = {f.name: f.dataType.simpleString() for f in thin.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(p.as_py()) for p in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return thin.mapInArrow(run, f"page_id {types[id_col]}, url {types[url_col]}, text string, n_chars long")
