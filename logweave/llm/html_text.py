"""HTML extraction by layout-aware rendering.

A tree is built from the tags, with the end tags that HTML lets authors leave
out (paragraphs, list items, table rows and cells, options) implied, unmatched
end tags ignored and open elements closed at the end. All visible text of the
tree is rendered: hidden elements (by kind, ``hidden`` attribute or inline style)
are left out, white space is collapsed outside ``pre``, blocks start new lines
(paragraph-like ones with a blank line around them), list items get a bullet or
their number and an indent, and table cells are padded to aligned columns.
``display: none`` hides an element with all that it holds; ``visibility`` is
inherited, so a visible element inside an invisible one is rendered. Text of forms
(options, text areas), formulas and drawings is visible; the titles, descriptions
and definitions of drawings are not.

Cells that span rows or columns take their place in the grid; a row spanned from
above is blank there. A table in a cell is rendered inside it, line by line. A
table whose spans make a grid of over ``SPARSE`` times its cells is not padded.

Null html gives null; html without visible text gives an empty string. The depth
of nesting is not limited (no recursion). Open elements are indexed by tag, so a
tag costs the same whatever is open; work is linear in the page but for the
columns that cells span (1,000 at most each).
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import small_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style title template noscript iframe noembed noframes object audio video canvas "
                   "datalist desc defs metadata symbol".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure article section hr".split())
BLOCK = SPACED | frozenset("html body div li dt dd tr caption header footer main nav aside form fieldset address center "
                           "details summary figcaption legend hgroup search menu dialog thead tbody tfoot option optgroup".split())
TABLE_PARTS = frozenset("thead tbody tfoot tr td th caption colgroup".split())
# An opening tag closes these open elements, up to the first of the listed scopes.
_LISTS, _TABLE = frozenset({"ul", "ol", "menu"}), frozenset({"table"})
IMPLIED = ({"li": (frozenset({"li"}), _LISTS), "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
            "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})), "option": (frozenset({"option"}), frozenset({"select"})),
            "td": (frozenset({"td", "th", "caption"}), frozenset({"tr", "table"})),
            "th": (frozenset({"td", "th", "caption"}), frozenset({"tr", "table"})),
            "tr": (frozenset({"tr", "td", "th", "caption"}), _TABLE), "body": (frozenset({"head"}), frozenset())}
           | {k: (frozenset({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}), _TABLE)
              for k in ("thead", "tbody", "tfoot")})
_P = frozenset({"p"})
_P_SCOPE = frozenset("table td th caption button body li dd".split())
_HEAD_TAGS = frozenset("base link meta script style title template noscript head html".split())
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
_GONE = re.compile(r"(?<![\w-])display\s*:\s*none(?![\w-])", re.I)
_VISIBILITY = re.compile(r"(?<![\w-])visibility\s*:\s*(visible|hidden|collapse)(?![\w-])", re.I)
_BLANK = re.compile(r"[ \t\r\n\f]+")
# A table with more places in its grid than so many times its cells is rendered without padding.
SPARSE = 64


class Node:
    __slots__ = ("tag", "attrs", "items", "hidden", "visible")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.items = tag, attrs, []
        style = attrs.get("style", "")
        self.hidden = (tag in HIDDEN or "hidden" in attrs or bool(_GONE.search(style))
                       or (tag == "dialog" and "open" not in attrs))
        said = _VISIBILITY.findall(style)
        self.visible = said[-1].lower() == "visible" if said else None  # None: as the element around it


class _Open:
    """The stack of open elements, with the places of each tag in it."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.places: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def last(self, tags) -> int:
        """Place of the innermost open element of these tags (0: none)."""
        return max([p[-1] for t in tags if (p := self.places.get(t))], default=0)

    def pop_to(self, place: int) -> None:
        while len(self.nodes) > place:
            self.places[self.nodes.pop().tag].pop()

    def close(self, tags: frozenset, scope: frozenset) -> None:
        """Close all elements of ``tags`` that are inside the innermost ``scope``."""
        limit = self.last(scope)
        while (at := self.last(tags)) > limit:
            self.pop_to(at)


def build(source: str) -> Node:
    """The tree of a page: nodes whose items are nodes and strings."""
    root = Node("html", {})
    opened = _Open(root)
    nodes = opened.nodes
    at = 0

    def text(t: str):
        if t:
            if nodes[-1].tag == "head" and t.strip():
                opened.pop_to(len(nodes) - 1)
            nodes[-1].items.append(html.unescape(t))

    while True:
        m = _TAG.search(source, at)
        if m is None:
            text(source[at:])
            return root
        text(source[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            place = opened.last((tag,))
            if tag == "p" and not place:
                nodes[-1].items.append(Node("p", {}))
            elif place and (tag in TABLE_PARTS or tag == "table" or opened.last(("td", "th")) <= place):
                opened.pop_to(place)  # an end tag in a cell closes nothing outside the cell
            continue
        attrs = {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTR.findall(m[3])} if m[3] else {}
        if tag == "html":
            continue
        if nodes[-1].tag == "head" and tag not in _HEAD_TAGS:
            opened.pop_to(len(nodes) - 1)
        if tag in IMPLIED:
            opened.close(*IMPLIED[tag])
        elif tag in BLOCK:
            opened.close(_P, _P_SCOPE)
        node = Node(tag, attrs)
        nodes[-1].items.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            inside = source[at:end.start() if end else len(source)]
            node.items.append(html.unescape(inside) if tag in ("textarea", "title") else inside)
            at = end.end() if end else len(source)
        elif tag not in VOID and not (m[3] or "").endswith("/"):
            opened.push(node)


class _Out:
    """Lines under construction: pending line breaks, pending blank, indent."""

    def __init__(self):
        self.parts: list[str] = []
        self.breaks = 0
        self.blank = False
        self.prefix = ""
        self.indent = ""

    def block(self, lines: int):
        if self.parts:
            self.breaks = max(self.breaks, lines)
        self.blank = False

    def write(self, t: str):
        if self.breaks:
            self.parts.append("\n" * self.breaks)
        if self.breaks or not self.parts:
            self.parts.append(self.indent + self.prefix)
            self.prefix = ""
        elif self.blank:
            self.parts.append(" ")
        self.breaks, self.blank = 0, False
        self.parts.append(t)

    def inline(self, t: str):
        words = _BLANK.sub(" ", t)
        if words.strip(" "):
            self.blank |= words[0] == " "
            self.write(words.strip(" "))
            self.blank = words[-1] == " "
        elif words:
            self.blank = True

    def text(self) -> str:
        return "".join(self.parts)


def _grid(rows: list[list[tuple[str, int, int]]]) -> list[str]:
    """Cells (text, columns, rows spanned) as lines with aligned columns; a cell's own lines stack up."""
    until: list[int] = []  # per column: the first row that no cell from above covers
    widths: list[int] = []
    placed: list[list[tuple[int, int, list[str]]]] = []
    cells = 0
    for r, row in enumerate(rows):
        col, line = 0, []
        for cell, span, down in row:
            while col < len(until) and until[col] > r:
                col += 1
            more = col + span - len(until)
            if more > 0:
                until += [0] * more
                widths += [0] * more
            for c in range(col, col + span):
                until[c] = r + down
            lines = cell.split("\n")
            if span == 1:
                widths[col] = max(widths[col], *map(len, lines))
            line.append((col, span, lines))
            col += span
        placed.append(line)
        cells += len(line)
        if len(widths) * (r + 1) > SPARSE * (cells + 1000):
            # hardly a place of the grid is used: all text, but no padding
            widths = [0] * max(map(len, rows))
            placed = [[(i, 1, x[0].split("\n")) for i, x in enumerate(row)] for row in rows]
            break
    out = []
    for row in placed:
        if not any(x.strip() for _, _, lines in row for x in lines):
            continue
        for k in range(max(len(lines) for _, _, lines in row)):
            text, at = "", 0
            for col, span, lines in row:
                if k < len(lines) and lines[k].strip():
                    # columns before it that hold nothing on this line
                    text += "".join(" " * w + " | " for w in widths[at:col]) if at < col else ""
                    text += lines[k].ljust(sum(widths[col:col + span]) + 3 * (span - 1)) + " | "
                    at = col + span
            out.append(text.removesuffix(" | ").rstrip())
    return out


def render(root: Node) -> str:
    """All visible text of a tree."""
    out = _Out()
    saved: list = []  # what to go back to when an element ends
    todo: list = [(root, 0, True)]  # with whether the text there is visible
    lists: list[list] = []  # open lists: [kind, next number]
    tables: list[list] = []  # open tables: rows
    pre = 0
    while todo:
        node, stage, seen = todo.pop()
        if isinstance(node, str):
            if not seen:
                continue
            if pre:
                for i, line in enumerate(node.expandtabs(4).split("\n")):
                    if i:
                        out.breaks = out.breaks + 1 if out.parts else 0
                        out.blank = False
                    if line:
                        out.write(line)
            else:
                out.inline(node)
            continue
        tag = node.tag
        if stage == 0:
            if node.hidden or (tag == "input" and node.attrs.get("type", "").lower() == "hidden"):
                continue
            if tag == "br":
                if out.parts:
                    out.breaks = min(out.breaks + 1, 2)
                out.blank = False
                continue
            if node.visible is not None:
                seen = node.visible
            if tag == "img":
                if seen and node.attrs.get("alt", "").strip():
                    out.inline(" " + node.attrs["alt"] + " ")
                continue
            if tag in VOID and tag != "hr":
                continue
            todo.append((node, 1, seen))
            if tag == "table":
                out.block(2)
                saved.append(out)
                tables.append([])
                out = _Out()
            elif tag == "tr" and tables:
                tables[-1].append([])
                saved.append(out)
                out = _Out()
            elif tag in ("td", "th") and tables:
                saved.append((out, lists))
                out, lists = _Out(), []
            elif tag in BLOCK:
                out.block(2 if tag in SPACED and not (tag in ("ul", "ol") and lists) else 1)
            if tag in ("ul", "ol", "menu"):
                first = node.attrs.get("start", "1")
                lists.append([tag, int(first) if first.lstrip("-").isdigit() and len(first) < 10 else 1])
            elif tag == "li":
                kind = lists[-1] if lists else ["ul", 1]
                saved.append((out.indent, out))
                out.indent = "  " * max(0, len(lists) - 1)
                out.prefix = f"{kind[1]}. " if kind[0] == "ol" else "- "
                kind[1] += 1
            pre += tag in ("pre", "listing", "textarea")
            todo += [(x, 0, seen) for x in reversed(node.items)]
            continue
        pre -= tag in ("pre", "listing", "textarea")
        if tag in ("ul", "ol", "menu"):
            lists.pop()
        elif tag == "li":
            out.indent, _ = saved.pop()
            out.prefix = ""
        if tag == "table":
            rest, out = out.text(), saved.pop()
            for line in (rest.split("\n") if rest else []) + _grid(tables.pop()):  # a caption and stray text first
                if line:
                    out.write(line)
                    out.block(1)
                elif out.parts:
                    out.breaks += 1
            out.block(2)
        elif tag == "tr" and tables:
            stray, out = out.text(), saved.pop()
            if stray:
                tables[-1][-1].append((stray, 1, 1))
        elif tag in ("td", "th") and tables:
            cell = out.text()
            out, lists = saved.pop()
            if not tables[-1]:
                tables[-1].append([])
            rows = tables[-1]
            rows[-1].append((cell, _span(node, "colspan", 1000), _span(node, "rowspan", 65534)))
        elif tag in BLOCK:
            out.block(2 if tag in SPACED and not (tag in ("ul", "ol") and lists) else 1)
    return out.text()


def _span(node: Node, name: str, most: int) -> int:
    """A cell's span: 1 unless a sensible number says otherwise; rows spanned "to the end" (0) are ``most``."""
    said = node.attrs.get(name, "1").strip()
    if not (said.isascii() and said.isdigit()) or len(said) > 9:
        return 1
    return min(int(said), most) or (most if name == "rowspan" else 1)


def extract(source: str | None) -> str | None:
    return None if source is None else render(build(source))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array([extract(x) for x in b.column(2).to_pylist()], pa.string())],
            ["page_id", "url", "text"])


def html_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text for every row."""
    small_batches(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")) \
        .mapInArrow(_extract, "page_id long, url string, text string")
