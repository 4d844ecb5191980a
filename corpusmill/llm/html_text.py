"""Visible text of HTML pages with their layout.

A tree is built from the page's tags with the implied ones added (an open
paragraph ends before a block, a list item before the next, cells and rows
before their like, and so on), invisible parts are dropped, and the tree is
rendered: blocks on lines of their own, paragraphs apart by an empty line, list
items with bullets or numbers and indented by depth, preformatted text as it is,
and table cells in columns of equal width. All visible text is given out: that of
formulas, of drawings' labels and of options too, but not what a drawing shows a
second time through ``use``.

Pages are independent of each other, so a task holds one page at a time.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.frames import Shielded

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template head title noscript iframe object datalist audio video canvas".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr fieldset".split())
BLOCK = APART | frozenset(
    "html body div section article aside header footer nav main address form li dt dd tr caption thead tbody tfoot td th "
    "details summary figcaption legend center dir menu".split()
)
#: what an open head may hold; anything else ends it
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: drawings and formulas: what of them is not shown, and what ends them as it cannot stand in them
SVG_HIDDEN = frozenset("defs desc metadata symbol clippath mask pattern marker filter lineargradient radialgradient".split())
MATH_HIDDEN = frozenset("annotation annotation-xml mphantom".split())
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre "
    "ruby s small span strong strike sub sup table tt u ul var".split()
)
HOLDS_HTML = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
SPACED = frozenset("text mtr mlabeledtr mtd".split())  # stand apart from what is beside them in a drawing or formula
#: tag -> open tags it ends, unless one of the barriers lies between
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, set()),
    "option": ({"option"}, {"select", "optgroup", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
}
STYLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)
SPACE = re.compile(r"[ \t\n\r\f]+")
MAX_DEPTH = 150  # deeper elements are laid out as their ancestor's; their text is kept


class Node:
    """An element; ``kind`` is empty or what it is part of: svg, label (a text of a drawing) or math."""

    __slots__ = ("tag", "attrs", "items", "kind")

    def __init__(self, tag: str, attrs: dict, kind: str = ""):
        self.tag, self.attrs, self.items, self.kind = tag, attrs, [], kind


class TreeBuilder(HTMLParser):
    """A page's elements; stray end tags are ignored, open ones end with their parent.

    Visible elements past MAX_DEPTH are open like others, but what they hold goes to
    their last ancestor above it; hidden ones there are left out with what they hold."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]
        self.at = defaultdict(list)  # tag -> where in ``open`` it is

    def push(self, node: Node) -> None:
        self.at[node.tag].append(len(self.open))
        self.open.append(node)

    def end_to(self, depth: int) -> None:
        for node in self.open[max(1, depth) :]:
            self.at[node.tag].pop()
        del self.open[max(1, depth) :]

    def last(self, tags: Iterable[str]) -> int:
        """Where the innermost open one of ``tags`` is, 0 without one."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def imply(self, tag: str) -> None:
        if tag not in HEAD and self.open[-1].tag == "head":
            self.end_to(len(self.open) - 1)
        if tag in BREAKOUT and (foreign := self.last(("svg", "math"))) > self.last(HOLDS_HTML):
            self.end_to(foreign)
        ends, barriers = ENDS.get(tag, ((), ()))
        while (i := self.last(ends)) > self.last(barriers):
            self.end_to(i)
        if tag in BLOCK and (i := self.last(("p",))) > self.last(("td", "th", "table", "li", "div")):
            self.end_to(i)

    def handle_starttag(self, tag, attrs):
        self.imply(tag)
        parent = self.open[-1]
        if tag in ("svg", "math"):
            kind = tag
        elif parent.kind == "svg" and tag in ("text", "foreignobject"):
            kind = "label" if tag == "text" else ""
        else:
            kind = parent.kind
        node = Node(tag, {k: v or "" for k, v in attrs}, kind)
        deep = len(self.open) >= MAX_DEPTH
        if not deep or visible(node):
            parent.items.append(node)
        if tag not in VOID:
            if deep and visible(node):
                node = Node(tag, {}, kind)
                node.items = parent.items
            self.push(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.end_to(len(self.open) - 1)

    def handle_endtag(self, tag):
        i = self.last((tag,))
        if i > (0 if tag in ("tr", "table", "td", "th", "thead", "tbody", "tfoot", "body", "html") else self.last(("td", "th", "table"))):
            self.end_to(i)

    def handle_data(self, data):
        if self.open[-1].tag == "head" and SPACE.sub("", data):
            self.end_to(len(self.open) - 1)
        if self.open[-1].kind != "svg":  # a drawing shows the text of its labels only
            self.open[-1].items.append(data)


def visible(node: Node) -> bool:
    a = node.attrs
    if node.tag in HIDDEN or "hidden" in a:
        return False
    if node.tag == "input" and a.get("type", "").lower() == "hidden":
        return False
    if node.kind == "math" and node.tag in MATH_HIDDEN:
        return False
    if node.kind in ("svg", "label") and (node.tag in SVG_HIDDEN or a.get("display") == "none" or a.get("visibility") in ("hidden", "collapse")):
        return False
    return not STYLE.search(a.get("style", ""))


class Layout:
    """Lines of text under construction."""

    def __init__(self):
        self.lines: list[str] = []
        self.line = ""
        self.prefix: list[str] = []  # what indents each line
        self.marker = ""  # of a list item, for its first line
        self.gap = False

    def flush(self) -> None:
        text = self.line.rstrip(" ")
        if text:
            if self.gap and self.lines:
                self.lines.append("")
            indent = "".join(self.prefix)
            if self.marker:
                indent = indent[: len(indent) - len(self.marker)] + self.marker
            self.lines.append(indent + text)
            self.gap, self.marker = False, ""
        self.line = ""

    def words(self, text: str) -> None:
        text = SPACE.sub(" ", text)
        if not self.line or self.line.endswith(" "):
            text = text.lstrip(" ")
        self.line += text

    def raw(self, text: str) -> None:
        parts = text.split("\n")
        for i, part in enumerate(parts):
            if i:
                if not self.line and self.lines:
                    self.lines.append("")
                self.flush()
            self.line += part

    def done(self) -> str:
        self.flush()
        return "\n".join(self.lines)


def render(root: Node) -> str:
    out = Layout()
    _render(root, out, False)
    return out.done()


def _render(node: Node, out: Layout, raw: bool) -> None:
    number = int(node.attrs["start"]) if node.tag == "ol" and re.fullmatch(r"-?[0-9]{1,9}", node.attrs.get("start", "")) else 1
    for item in node.items:
        if isinstance(item, str):
            out.raw(item) if raw else out.words(item)
            continue
        if not visible(item):
            continue
        tag = item.tag
        if tag == "br":
            out.flush() if out.line else out.lines and out.lines[-1] and out.lines.append("")
        elif tag == "img":
            out.words(item.attrs.get("alt", ""))
        elif tag == "input":
            out.words(item.attrs.get("value", "") if item.attrs.get("type", "").lower() in ("", "text", "submit", "button", "reset") else "")
        elif tag == "table":
            out.flush()
            out.gap = True
            _table(item, out)
            out.gap = True
        elif tag == "li":
            out.flush()
            marker = f"{number}. " if node.tag == "ol" else "- "
            number += 1
            out.prefix.append(" " * len(marker))
            out.marker = marker
            _render(item, out, raw)
            out.flush()
            out.marker = ""
            out.prefix.pop()
        elif tag in ("option", "optgroup"):
            out.flush()
            out.words(item.attrs.get("label", ""))
            if tag == "optgroup":
                out.flush()
            if tag == "optgroup" or not item.attrs.get("label"):  # an option's label is shown for its text
                _render(item, out, raw)
            out.flush()
        elif item.kind and tag in SPACED:
            out.words(" ")
            _render(item, out, raw)
            out.words(" ")
        elif tag in BLOCK:
            out.flush()
            apart = tag in APART and not (tag in ("ul", "ol") and out.prefix)
            out.gap = out.gap or apart
            if tag in ("blockquote", "dd"):
                out.prefix.append("  ")
            _render(item, out, raw or tag == "pre")
            out.flush()
            if tag in ("blockquote", "dd"):
                out.prefix.pop()
            out.gap = out.gap or apart
        else:
            _render(item, out, raw)


def _rows(table: Node) -> Iterator[tuple[str, Node]]:
    for item in table.items:
        if isinstance(item, str):
            if item.strip():
                yield "text", item
        elif visible(item):
            if item.tag in ("thead", "tbody", "tfoot"):
                yield from _rows(item)
            else:
                yield ("row" if item.tag == "tr" else "other"), item


def _table(table: Node, out: Layout) -> None:
    """Rows as lines, cells padded to their column's width; the lines of a cell
    become one. What a table holds outside its rows stands above or between them."""
    grid: list[list[str] | str] = []
    for kind, item in _rows(table):
        if kind == "text":
            grid.append(SPACE.sub(" ", item).strip())
        elif kind == "other":
            grid.append(render(_wrap(item)))
        else:
            cells: list[str] = []
            for cell in item.items:
                if isinstance(cell, str):
                    if cell.strip():
                        cells.append(SPACE.sub(" ", cell).strip())
                elif visible(cell):
                    text = " ".join(x.strip() for x in render(_wrap(cell)).split("\n") if x.strip())
                    cells.append(text)
                    span = cell.attrs.get("colspan", "")
                    cells += [""] * (min(int(span), 100) - 1 if re.fullmatch("[0-9]{1,4}", span) and int(span) > 1 else 0)
            grid.append(cells)
    width: dict[int, int] = {}
    for cells in grid:
        if not isinstance(cells, str):
            for i, c in enumerate(cells):
                width[i] = max(width.get(i, 0), len(c))
    for cells in grid:
        if isinstance(cells, str):
            for line in cells.split("\n"):
                out.line = line
                out.flush()
        else:
            out.line = "  ".join(c.ljust(width[i]) for i, c in enumerate(cells))
            out.flush()


def _wrap(node: Node) -> Node:
    top = Node("", {})
    top.items.append(node)
    return top


def page_text(html: str) -> str:
    """The visible text of one page."""
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return render(builder.root)


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` plus ``page_text``.

    A null page gives null, an empty one an empty text; text without tags is given
    as a paragraph. Tags are never an error: unknown ones are inline, unclosed ones
    end with their parent. Repeated rows get equal results and an empty table an
    empty result. A column of ``pages`` called ``page_text`` is replaced."""
    side = Shielded(pages)
    body = side.col(html)
    schema = T.StructType([*side.df.schema.fields, T.StructField("page_text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(body))
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [None if h is None else page_text(h) for h in column.slice(a, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "page_text"])

    out = side.df.mapInArrow(run, schema)
    own = [F.col(c).alias(n) for c, n in zip(side.columns, side.names) if n != "page_text"]
    return out.select(*own, "page_text")
