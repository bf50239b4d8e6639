"""Visible text of HTML pages, laid out as a reader would see it.

A tree is built from the tags, with the tags HTML implies: a block closes an open paragraph, an
item closes the item before it, cells imply rows, rows imply a table body, what is never closed
closes at the end. Elements that are not shown (head, scripts, ``hidden``, ``display:none`` and so
on) are left out with all they hold. The rest is written with white space folded, blocks on lines
of their own, a blank line around paragraphs, headings, lists and tables, item markers with nested
indents, preformatted text as it is, and table cells padded to their column's width.

A null or empty page gives an empty text, as does a page without visible text. Tags that are never
completed are dropped; a lone ``<`` is text. Nesting beyond ``MAX_DEPTH`` goes on at that depth, as
browsers do. Whole pages are rendered; work is linear in their length. Input columns are kept; one
named like the output is replaced.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidebook.llm.bpe import blocks
from tidebook.llm.common import append_columns, ship

MAX_DEPTH = 512

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
RCDATA = frozenset("title textarea".split())
HIDDEN = frozenset("head script style template noscript title iframe noembed noframes object video audio canvas svg math datalist rp".split())
HEAD_ONLY = frozenset("base link meta title style script noscript template".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table ul"
    " option optgroup caption thead tbody tfoot tr".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir table blockquote pre hr figure".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
LISTS = frozenset("ul ol menu dir".split())
#: A start tag closes these open elements, not looking beyond the given ones.
IMPLIED_ENDS = {
    "li": ({"li"}, LISTS),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
}
#: An end tag does not reach beyond these, unless it is one of them; one of a table part only stops at a table.
SCOPES = frozenset("table td th caption html template button".split())
TABLE_PARTS = frozenset("table caption thead tbody tfoot tr td th".split())
TABLE_SCOPES = frozenset("table html template".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>[^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+)>",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
UNSEEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
FOLD = re.compile(r"[ \t\n\r\f]+")
FOLDED = " \t\n\r\f"


class Node:
    __slots__ = ("tag", "children", "shown", "attributes")

    def __init__(self, tag: str, attributes: dict[str, str], shown: bool):
        self.tag, self.attributes, self.shown = tag, attributes, shown
        self.children: list[Node | str] = []


def attributes_of(rest: str) -> dict[str, str]:
    if not rest or rest.isspace():
        return {}
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(rest)}


def is_shown(tag: str, attributes: dict[str, str]) -> bool:
    if tag in HIDDEN or "hidden" in attributes:
        return False
    if tag == "dialog" and "open" not in attributes or tag == "input" and attributes.get("type", "").lower() == "hidden":
        return False
    return not ("style" in attributes and UNSEEN.search(attributes["style"]))


class TreeBuilder:
    """Open elements and the tree so far. Hidden elements are tracked but hold nothing."""

    def __init__(self):
        self.root = Node("html", {}, True)
        self.stack = [self.root]

    def close_through(self, at: int) -> None:
        del self.stack[at:]

    def find(self, tags, limits) -> int | None:
        for at in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[at].tag
            if tag in tags:
                return at
            if tag in limits:
                return None
        return None

    def push(self, tag: str, attributes: dict[str, str]) -> None:
        above = self.stack[-1]
        node = Node(tag, attributes, above.shown and is_shown(tag, attributes))
        if above.shown:
            above.children.append(node)
        if tag not in VOID:
            if len(self.stack) >= MAX_DEPTH:
                self.stack.pop()
            self.stack.append(node)

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag == "html":
            return
        if tag not in HEAD_ONLY and (at := self.find({"head"}, ())) is not None and tag != "head":
            self.close_through(at)  # anything but head content ends the head
        if tag == "body":
            if not is_shown(tag, attributes):
                self.push(tag, attributes)
            return
        if tag in CLOSES_P and (at := self.find({"p"}, SCOPES)) is not None:
            self.close_through(at)
        if tag in IMPLIED_ENDS:
            closes, limits = IMPLIED_ENDS[tag]
            while (at := self.find(closes, limits)) is not None:
                self.close_through(at)
            if tag in ("td", "th", "tr"):
                self.imply_rows(tag)
        self.push(tag, attributes)

    def imply_rows(self, tag: str) -> None:
        if self.find({"table"}, ()) is None:
            return
        if self.find({"thead", "tbody", "tfoot"}, {"table"}) is None:
            self.push("tbody", {})
        if tag != "tr" and self.find({"tr"}, {"table"}) is None:
            self.push("tr", {})

    def end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "br":
            self.push("br", {})
            return
        at = self.find({tag}, (TABLE_SCOPES if tag in TABLE_PARTS else SCOPES) - {tag})
        if at is not None:
            self.close_through(at)
        elif tag == "p":
            self.push("p", {})
            self.stack.pop()

    def text(self, data: str) -> None:
        if data and self.stack[-1].shown:
            self.stack[-1].children.append(unescape(data) if "&" in data else data)


def parse(html: str) -> Node:
    builder, at, last = TreeBuilder(), 0, html.rfind(">") + 1
    while True:
        found = TAG.search(html, at, last) if at < last else None
        if found is None:
            rest = html[at:]
            cut = re.search(r"<(?:[a-zA-Z/!?])", rest)
            builder.text(rest[: cut.start()] if cut else rest)
            return builder.root
        builder.text(html[at : found.start()])
        at, name = found.end(), found["name"]
        if name is None:
            continue
        tag = name.lower()
        if found["end"]:
            builder.end(tag)
            continue
        builder.start(tag, attributes_of(found["rest"]))
        if tag in RAW or tag in RCDATA:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            stop = close.start() if close else len(html)
            if tag in RCDATA or tag == "xmp":
                builder.text(html[at:stop])
            builder.end(tag)
            at = html.find(">", stop) + 1 if close else len(html)
            at = at or len(html)


class Page:
    """Lines of text. ``gap`` is the space owed before the next line: 1 a new line, 2 a blank one."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space, self.gap, self.marker = False, 0, ""
        self.indents: list[str] = []

    def put(self, data: str, kept: bool) -> None:
        if kept:
            first, *more = data.replace("\r\n", "\n").split("\n")
            self.now.append(first)
            for line in more:
                self.newline()
                self.now.append(line)
            return
        words = FOLD.sub(" ", data)
        if not (inner := words.strip(" ")):
            self.space = self.space or bool(words)
            return
        if self.now and (self.space or words[0] == " "):
            self.now.append(" ")
        self.now.append(inner)
        self.space = words[-1] == " "

    def flush(self) -> None:
        if self.now:
            line = "".join(self.now)
            self.now.clear()
            if line.strip():
                if self.lines and self.gap > 1:
                    self.lines.append("")
                indent = "".join(self.indents)
                if self.marker:
                    indent = indent[: len(indent) - len(self.marker)] + self.marker
                    self.marker = ""
                self.lines.append((indent + line).rstrip())
                self.gap = 0
        self.space = False

    def newline(self) -> None:
        if self.now:
            self.flush()
        elif self.lines:
            self.lines.append("")

    def block(self, gap: int) -> None:
        self.flush()
        self.gap = max(self.gap, gap)

    def take(self) -> list[str]:
        self.flush()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def span(node: Node) -> int:
    value = node.attributes.get("colspan", "1").strip()
    return min(max(int(value), 1), 1000) if value.isascii() and value.isdigit() and len(value) < 5 else 1


def aligned(rows: list[list[tuple[list[str], int]]]) -> list[str]:
    """Lines of a table: every column as wide as its widest cell, two spaces between."""
    widths: dict[int, int] = {}
    for row in rows:
        at = 0
        for lines, columns in row:
            if columns == 1:
                widths[at] = max(widths.get(at, 0), *(len(x) for x in lines), 0) if lines else widths.get(at, 0)
            at += columns
    out = []
    for row in rows:
        for n in range(max((len(lines) for lines, _ in row), default=0)):
            line, at = "", 0
            for lines, columns in row:
                width = sum(widths.get(i, 0) for i in range(at, at + columns)) + 2 * (columns - 1)
                line += (lines[n] if n < len(lines) else "").ljust(width) + "  "
                at += columns
            out.append(line.rstrip())
    return out


def render(root: Node) -> str:
    pages, tables, lists, pre = [Page()], [], [], 0
    walk: list[tuple[Node, int]] = [(root, 0)]
    while walk:
        node, at = walk.pop()
        tag = node.tag
        if at == 0:
            page = pages[-1]
            if tag == "br":
                page.newline()
                page.space = False
            elif tag in ("td", "th") and tables:
                pages.append(Page())
            elif tag == "table":
                page.block(2)
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in BLOCK:
                page.block(2 if tag in SPACED and not (tag in LISTS and lists) else 1)
                if tag in LISTS:
                    start = node.attributes.get("start", "1").strip()
                    lists.append([tag, int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1])
                elif tag == "li":
                    kind, number = lists[-1] if lists else ("ul", 1)
                    marker = f"{number}. " if kind == "ol" else "- "
                    if lists:
                        lists[-1][1] += 1
                    page.indents.append(" " * len(marker))
                    page.marker = marker
                elif tag in ("blockquote", "dd"):
                    page.indents.append("  ")
                elif tag == "pre":
                    pre += 1
            elif tag in ("td", "th"):
                page.space = True
        children = node.children
        while at < len(children):
            child = children[at]
            at += 1
            if isinstance(child, str):
                pages[-1].put(child, pre > 0)
            elif child.shown:
                walk.append((node, at))
                walk.append((child, 0))
                break
        else:
            page = pages[-1]
            if tag in ("td", "th") and tables and len(pages) > 1:
                lines = pages.pop().take()
                if not tables[-1]:
                    tables[-1].append([])
                tables[-1][-1].append((lines, span(node)))
            elif tag == "table":
                for line in aligned(tables.pop()):
                    page.now.append(line)
                    page.flush()
                page.block(2)
            elif tag in BLOCK and tag not in ("tr", "tbody", "thead", "tfoot"):
                page.block(2 if tag in SPACED and not (tag in LISTS and len(lists) > 1) else 1)
                if tag in LISTS:
                    lists.pop()
                elif tag == "li":
                    page.indents.pop()
                    page.marker = ""
                elif tag in ("blockquote", "dd"):
                    page.indents.pop()
                elif tag == "pre":
                    pre -= 1
    return "\n".join(pages[0].take())


def visible_text(html: str | None) -> str:
    return render(parse(html)) if html else ""


def extract(df: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``df`` with ``out`` string: the visible text of the whole page in ``html``."""
    ship(df.sparkSession)

    def run(batch: pa.RecordBatch):
        column = batch.column(0)
        for start, rows in blocks(pa.compute.binary_length(column).fill_null(0).to_pylist(), 4_000_000):
            yield start, rows, [pa.array([visible_text(x) for x in column.slice(start, rows).to_pylist()], pa.string())]

    return append_columns(df, [html], [(out, T.StringType())], run)
