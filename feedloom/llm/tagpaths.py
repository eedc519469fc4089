"""Main text of web pages by tag-path ratios.

A page is read once, tag by tag, into text nodes with their root-to-leaf tag path (tag names with class, id and role). For every path
of the page two ratios are aggregated over its text nodes: text length per node, and punctuation per node. Both are smoothed over
neighbouring nodes in page order, so a short paragraph between long ones is not lost, and fused by their product, scaled by the
page's own mean. Paths whose fused ratio is above ``THRESHOLD`` of the mean are content.

Scripts, styles, comments and the controls and labels of forms are no text nodes. Names only weigh: a path through an element that is a
form, or whose class, id or role speaks of adverts, menus, notices, reader comments and the like, weighs ``LITTLE``, a path inside an article or main
element weighs ``MUCH``, and the ratios of the page decide. Navigation, header, footer, aside, menu and dialog elements are
left out. Neither holds for an element that holds the page's article, an article or main element that has no such name around it, whatever its own
names; where a page has none, class names do not weigh on an element with half of its text or more. So layout classes around an article and a form around the whole page change nothing.

If a page marks an article, headings and short blocks within the content's own subtree follow it: a node is kept if its path
is content, or if it is a block of the deepest common ancestor of the content nodes and no boilerplate.

Blocks are separated by block-level tags; white space inside a block is one space, and character references are decoded.
All pages are read whole, in tasks, one at a time.

Defined results: a null or empty html has an empty text. Unclosed and stray end tags are tolerated: an end tag closes up to its
start tag, or nothing. Rows repeated are alike. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import Batches

#: Content paths have at least this part of the page's mean fused ratio.
THRESHOLD = 0.3
#: Neighbours on each side that ratios are smoothed over.
SMOOTH = 1
#: Weights of paths through boilerplate and through marked content.
LITTLE = 0.01
MUCH = 4.0

# Fixed values of HTML: elements without an end tag, elements whose text is no page text, and inline elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template svg head title textarea select option iframe object canvas button annotation annotation-xml".split())
#: Silent inside a form.
CAPTIONS = frozenset("label legend".split())
RAW = frozenset("script style textarea title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle mspace mtable mtr mtd semantics annotation annotation-xml".split()
)
BOILERPLATE_TAGS = frozenset("nav header footer aside menu dialog".split())
CONTENT_TAGS = frozenset("article main".split())
#: Elements that end an open element of the first name when they start.
CLOSES = {"p": frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
          "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"])}

_MARK = re.compile(r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*+>?|(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>)", re.S)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?:\s|=|$)|style\s*=\s*[\"'][^\"']*display\s*:\s*none|aria-hidden\s*=\s*[\"']?true)", re.I)
_SPACE = re.compile(r"\s+")
_MARKS = re.compile(r"[.,;:!?…。，；：！？]")
_BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumb\w*|header|footer|foot|sidebar|side|aside|cookie\w*|consent|notice|gdpr|"
    r"popup|modal|newsletter|subscribe|signup|login|share|sharing|social|related|recommend\w*|widget|toolbar|pagination|pager|copyright|legal|disclaimer|"
    r"comment\w*|replies|reply|disqus|respond|discussion|search|complementary|contentinfo|navigation)(?=$|[\s_-])", re.I,
)


class _Node:
    """An element: its path as a number, what its names say, what it holds, and its place in the tree.

    ``named`` and ``tagged``: its class names, or its tag, speak of boilerplate. ``size`` counts the characters of text below
    it, ``article`` says that it is the page's article or main element, ``holds`` that one with text is in it, ``amid`` that names of boilerplate are around. ``poor`` and ``out``
    are what follows for the text below it. ``first`` and ``last`` number the elements from this one to the last below it; ``block`` is the nearest element, this one
    included, that is not inline.
    """

    __slots__ = ("name", "path", "silent", "named", "tagged", "rich", "article", "amid", "first", "last", "depth", "up", "block", "size", "holds", "poor", "out")

    def __init__(self, name: str, path: int, silent: bool, named: bool, tagged: bool, article: bool, first: int, depth: int, up: _Node | None):
        self.name, self.path, self.silent, self.named, self.tagged, self.article = name, path, silent, named, tagged, article
        self.rich = name in CONTENT_TAGS or up is not None and up.rich
        self.amid = named or tagged or up is not None and up.amid
        self.first, self.last, self.depth, self.up = first, None, depth, up
        self.block = self if up is None or name not in INLINE else up.block
        self.size, self.holds, self.poor, self.out = 0, False, False, False


def blocks(page: str) -> list[tuple[str, _Node]]:
    """The page's text blocks in order, each with the block-level element it stands in."""
    top = _Node("", 0, False, False, False, False, 0, 0, None)
    stack, out, held, nodes = [top], [], [], [top]
    paths: dict[tuple[int, str, str], int] = {}
    opened: dict[str, int] = {}
    count = 0

    def flush() -> None:
        if held:
            text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
            if text:
                out.append((text, stack[-1].block))
                stack[-1].block.size += len(text)
            held.clear()

    def close(depth: int) -> None:
        if any(n.name not in INLINE for n in stack[depth:]):
            flush()
        for node in stack[depth:]:
            node.last = count
            opened[node.name] -= 1
        del stack[depth:]

    at = 0
    while at < len(page):
        if stack[-1].name in RAW:
            end = re.compile(rf"</{stack[-1].name}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            close(len(stack) - 1)
            continue
        mark = _MARK.search(page, at)
        if not stack[-1].silent:
            held.append(page[at:mark.start() if mark else len(page)])
        if not mark:
            break
        at = mark.end()
        name = (mark.group(2) or "").lower()
        if not name:
            continue
        if mark.group(1):
            if opened.get(name):
                depth = len(stack) - 1
                while stack[depth].name != name:
                    depth -= 1
                close(depth)
            elif name not in INLINE:
                flush()
            continue
        near = stack[-1].block
        for ended in (near, near.up.block if near.name == "p" and near.up else near):
            if name in CLOSES.get(ended.name, ()):
                close(ended.depth)
                break
        if name not in INLINE:
            flush()
        if name in VOID:
            continue
        rest = mark.group(3)
        said = " ".join(filter(None, (g for m in _NAMES.finditer(rest) for g in m.groups()))).lower()
        up = stack[-1]
        count += 1
        path = up.path if name in INLINE else paths.setdefault((up.path, name, said), len(paths) + 1)
        silent = up.silent or name in SILENT or name in CAPTIONS and bool(opened.get("form")) or bool(_HIDDEN.search(rest))
        named = name == "form" or bool(said and name not in ("html", "body") and _BOILERPLATE.search(said))
        tagged = name in BOILERPLATE_TAGS and not (name == "header" and up.rich)
        # An article inside an article, or among boilerplate, is a reader's comment or a teaser if its names say so.
        article = name in CONTENT_TAGS and not (named and (up.rich or up.amid))
        node = _Node(name, path, silent, named and not article, tagged, article, count, len(stack), up)
        stack.append(node)
        nodes.append(node)
        opened[name] = opened.get(name, 0) + 1
    flush()
    for node in stack:
        node.last = count
    _judge(nodes)
    return out


def _judge(nodes: list[_Node]) -> None:
    """Set ``poor`` and ``out`` of all elements, in the order of their start tags."""
    for node in reversed(nodes[1:]):
        node.up.size += node.size
        node.up.holds |= node.holds or node.article and node.size > 0
    top = nodes[0]
    for node in nodes[1:]:
        most = not top.holds and 2 * node.size >= top.size
        node.out = node.up.out or node.tagged and not node.holds
        node.poor = node.up.poor or node.out or node.named and not (node.holds or most)


def content(page: str) -> str:
    """The main text: content blocks in page order with two line breaks between them."""
    found = blocks(page)
    if not found:
        return ""
    paths = {p: i for i, p in enumerate(dict.fromkeys(n.path for _, n in found))}
    place = np.array([paths[n.path] for _, n in found])
    length = np.array([len(t) for t, _ in found], np.float64)
    marks = np.array([len(_MARKS.findall(t)) for t, _ in found], np.float64)
    nodes = np.bincount(place)
    text_ratio = _smooth((np.bincount(place, length) / nodes)[place])
    mark_ratio = _smooth((np.bincount(place, marks) / nodes)[place])
    weight = np.array([(LITTLE if n.poor else 1.0) * (MUCH if n.rich else 1.0) for _, n in found])
    fused = text_ratio * (1 + mark_ratio) * weight
    chosen = (fused >= THRESHOLD * fused.mean()) & ~np.array([n.out for _, n in found])
    if not chosen.any():
        return ""
    root = _common([found[i][1] for i in np.flatnonzero(chosen)])
    if root.rich:
        while root.up is not None and root.up.rich:
            root = root.up
    kept = [t for i, (t, n) in enumerate(found) if chosen[i] or root.rich and not n.poor and _inside(n, root)]
    return "\n\n".join(kept)


def _smooth(values: np.ndarray) -> np.ndarray:
    wide = np.pad(values, SMOOTH, mode="edge")
    return sum(wide[i:i + len(values)] for i in range(2 * SMOOTH + 1)) / (2 * SMOOTH + 1)


def _inside(node: _Node, root: _Node) -> bool:
    return root.first <= node.first <= root.last


def _common(nodes: list[_Node]) -> _Node:
    """The deepest element that all the nodes are in."""
    root = nodes[0]
    for node in nodes[1:]:
        while not _inside(node, root):
            root = root.up
    return root


def extracted(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("html"))
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = [content(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())], names=schema.names,
            )

    return rows.mapInArrow(run, schema)
