"""HTML extraction by laying out the visible text.

A tree builder with the implied end tags of HTML turns the markup into a
tree; elements that a browser does not show are left out; what remains is
rendered as text: blocks stand on lines of their own, paragraphs and headings
have a blank line around them, list items carry bullets or numbers and are
indented by depth, table cells are padded to common column widths, and
preformatted text keeps its white space.

Results:

* one row for each page, NULL and repeated ids included;
* NULL and empty pages give an empty text;
* markup that is cut off or badly nested never fails: open elements end with
  the page, end tags without a start are ignored;
* nesting deeper than ``DEEPEST`` is flattened: its text is kept;
* an empty table gives an empty table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.llm.common import arrow_map, texts

DEEPEST = 200

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head script style template title noscript iframe noembed noframes object audio video canvas svg math select datalist meta link".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table ul caption".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure hr".split())
# A start tag ends these open elements, looking no further than the given limits.
ENDS_PARAGRAPH = BLOCK - {"body", "html", "caption", "legend"}
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
SCOPE = frozenset("html table td th caption button object".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
BLANKS = re.compile(r"[ \t\n\r\f]+")
INVISIBLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)


@dataclass
class Node:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)  # nodes and texts


def attributes(raw: str) -> dict[str, str]:
    return {
        name.lower(): unescape(a or b or c or "") for name, a, b, c in ATTRIBUTE.findall(raw)
    } if raw.strip(" /") else {}


def parse(html: str) -> Node:
    """The tree of a page."""
    root = Node("#root")
    stack = [root]
    at = 0
    while at < len(html):
        found = TOKEN.search(html, at)
        if not found:
            stack[-1].children.append(unescape(html[at:]))
            break
        if found.start() > at:
            stack[-1].children.append(unescape(html[at : found.start()]))
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            _close(stack, tag)
            continue
        _imply(stack, tag)
        node = Node(tag, attributes(found[3]))
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            text = html[at : end.start()] if end else html[at:]
            node.children.append(unescape(text) if tag in ("title", "textarea") else text)
            at = end.end() if end else len(html)
        elif tag not in VOID and not found[3].endswith("/") and len(stack) < DEEPEST:
            stack.append(node)
    return root


def _imply(stack: list[Node], tag: str) -> None:
    """End the open elements that a start tag ends."""
    if tag in ENDS_PARAGRAPH:
        _end(stack, {"p"}, SCOPE)
    if tag in IMPLIED:
        ends, limits = IMPLIED[tag]
        _end(stack, ends, limits)


def _end(stack: list[Node], ends, limits) -> None:
    """Close the outermost of ``ends`` that is open inside the nearest limit."""
    last = None
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in limits:
            break
        if stack[depth].tag in ends:
            last = depth
    if last is not None:
        del stack[last:]


def _close(stack: list[Node], tag: str) -> None:
    if tag == "br":
        stack[-1].children.append(Node("br"))
        return
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag == tag:
            del stack[depth:]
            return
        # A stray end tag closes no table around it.
        if stack[depth].tag in ("table", "td", "th") and tag not in ("table", "tr", "tbody", "thead", "tfoot"):
            return


def visible(node: Node) -> bool:
    if node.tag in HIDDEN or "hidden" in node.attributes:
        return False
    if node.tag == "input" and node.attributes.get("type", "").lower() == "hidden":
        return False
    style = node.attributes.get("style")
    return not (style and INVISIBLE.search(style))


class Page:
    """Lines of text with pending blank lines, as blocks are laid out."""

    def __init__(self, width: int | None = None):
        self.lines: list[str] = []
        self.line = ""
        self.gap = 0  # blank lines asked for before the next text
        self.indent = ""
        self.marker = ""  # bullet or number of the item that begins
        self.tables = self.items = 0

    def text(self, raw: str, keep: bool = False) -> None:
        if keep:
            first, *rest = raw.split("\n")
            self._put(first, True)
            for line in rest:
                self.newline(True)
                self._put(line, True)
            return
        raw = BLANKS.sub(" ", raw)
        if not self.line or self.line.endswith(" "):
            raw = raw.lstrip(" ")
        if raw:
            self._put(raw, False)

    def _put(self, raw: str, keep: bool) -> None:
        if not raw:
            return
        if not self.line:
            if self.gap and self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            self.line = self.indent + self.marker
            if self.marker:
                self.indent += " " * len(self.marker)
                self.marker = ""
        self.line += raw

    def newline(self, force: bool = False) -> None:
        if self.line or force:
            self.lines.append(self.line.rstrip(" "))
        self.line = ""

    def block(self, gap: int) -> None:
        self.newline()
        self.gap = max(self.gap, gap)

    def done(self) -> str:
        self.newline()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return "\n".join(self.lines)


def render(node: Node, page: Page, keep: bool = False) -> None:
    number = 0
    for child in node.children:
        if isinstance(child, str):
            page.text(child, keep)
            continue
        if not visible(child):
            continue
        tag = child.tag
        if tag == "br":
            page.newline(True)
        elif tag == "hr":
            page.block(1)
            page.text("---")
            page.block(1)
        elif tag == "table":
            page.tables += 1
            page.block(1)
            for line in table_lines(child, page):
                page.text(line, True)
                page.newline(True)
            page.block(1)
        elif tag == "li":
            page.items += 1
            if node.tag == "ol":
                start = child.attributes.get("value") or (node.attributes.get("start") if not number else None)
                number = int(start) if start and re.fullmatch(r"-?\d{1,9}", start) else number + 1
            page.block(0)
            indent = page.indent
            page.marker = f"{number}. " if node.tag == "ol" else "- "
            render(child, page, keep)
            page.block(0)
            page.indent, page.marker = indent, ""
        elif tag in BLOCK:
            nested = tag in ("ul", "ol") and node.tag == "li"
            gap = 1 if tag in SPACED and not nested else 0
            indent = page.indent
            page.block(gap)
            if tag in ("blockquote", "dd"):
                page.indent += "  "
            render(child, page, keep or tag == "pre")
            page.block(gap)
            if tag in ("blockquote", "dd"):
                page.indent = indent
        elif tag in ("td", "th", "tr", "tbody", "thead", "tfoot"):  # outside a table
            page.text(" ")
            render(child, page, keep)
        else:
            render(child, page, keep)


def table_lines(table: Node, page: Page) -> list[str]:
    """Caption and rows with aligned cells; a cell may hold several lines."""
    caption, rows = [], []

    def gather(node: Node) -> None:
        row = None
        for child in node.children:
            if isinstance(child, str):
                if child.strip():
                    caption.append(BLANKS.sub(" ", child).strip())
                continue
            if not visible(child):
                continue
            if child.tag == "tr":
                rows.append([])
                gather_cells(child, rows[-1])
            elif child.tag in ("td", "th"):  # a row without its tag
                if row is None:
                    rows.append(row := [])
                row.append(child)
            elif child.tag in ("tbody", "thead", "tfoot"):
                gather(child)
            elif child.tag not in ("colgroup", "col"):
                caption.append(_inner(child, page))

    def gather_cells(node: Node, row: list) -> None:
        for child in node.children:
            if isinstance(child, str):
                if child.strip():
                    row.append(Node("td", {}, [child]))
            elif visible(child):
                row.append(child)

    gather(table)
    cells = [[_inner(cell, page).split("\n") for cell in row] for row in rows]
    spans = [[_span(cell) for cell in row] for row in rows]
    widths: list[int] = []
    for row, span in zip(cells, spans, strict=True):
        column = 0
        for cell, wide in zip(row, span, strict=True):
            if wide == 1:
                widths += [0] * (column + 1 - len(widths))
                widths[column] = max(widths[column], *map(len, cell))
            column += wide
    lines = [line for text in caption if text for line in text.split("\n")]
    for row, span in zip(cells, spans, strict=True):
        for k in range(max(map(len, row), default=0)):
            column, line = 0, []
            for cell, wide in zip(row, span, strict=True):
                room = sum(widths[column : column + wide]) + 3 * (wide - 1)
                line.append((cell[k] if k < len(cell) else "").ljust(room))
                column += wide
            lines.append(" | ".join(line).rstrip(" "))
    return lines


def _span(cell: Node) -> int:
    raw = cell.attributes.get("colspan", "1")
    return min(max(int(raw), 1), 1000) if re.fullmatch(r"\d{1,9}", raw) else 1


def _inner(node: Node, page: Page) -> str:
    inner = Page()
    render(node, inner)
    text = inner.done()
    page.tables += inner.tables
    page.items += inner.items
    return text


def extract(html: str) -> tuple[str, int, int]:
    """The visible text of a page, and how many tables and list items it shows."""
    page = Page()
    render(parse(html), page)
    return page.done(), page.tables, page.items


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id``, ``text``, ``n_chars``, ``n_tables`` and ``n_items`` of every page; no shuffle."""

    def run(batch):
        found = [extract(raw.decode()) for raw in texts(batch, "html")]
        return {
            "page_id": batch.column("page_id"),
            "text": [t for t, _, _ in found],
            "n_chars": [len(t) for t, _, _ in found],
            "n_tables": [n for _, n, _ in found],
            "n_items": [n for _, _, n in found],
        }

    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), "html")
    return arrow_map(narrow, run, "page_id long, text string, n_chars long, n_tables long, n_items long")
