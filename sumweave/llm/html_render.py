"""Visible text of HTML pages, laid out.

A small tree builder reads tags, attributes and character references, closes what HTML leaves
implied, and knows which elements hold raw text. The tree is then rendered: hidden elements are
skipped, blocks stand on lines of their own, paragraphs and headings have an empty line around them,
list items are marked and indented, and the cells of a table are aligned in columns.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of HTML: elements without an end tag, with raw text, never shown, on lines of their own, and with an empty line around.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = frozenset("""head script style template noscript iframe canvas audio video datalist noembed noframes title meta link
 desc defs metadata symbol annotation annotation-xml""".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
 h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table ul""".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure article section main hr".split())
#: An opening tag ends these open elements, looked for up to one of the limits.
_CLOSES = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
           "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
           "thead": (("thead", "tbody", "tfoot"), ("table",)), "tbody": (("thead", "tbody", "tfoot"), ("table",)),
           "tfoot": (("thead", "tbody", "tfoot"), ("table",)), "option": (("option",), ("select", "datalist")),
           "body": (("head",), ()), "caption": (("caption",), ("table",))}
#: Parts of a table, whose end tags close what is open in a cell; and elements that other end tags do not close.
_PARTS = frozenset("caption thead tbody tfoot tr td th".split())
_FENCE = frozenset("table td th caption html template".split())
#: Nested deeper than this, what is shown is laid out as if it stood at this depth; what is hidden stays hidden.
DEPTH = 200
#: Ends the line of a block that is laid out so.
_END = "#end"

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"']|[\"'](?![^>]*>))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"[ \t\n\f\r]+")
_GONE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []

    def get(self, name: str) -> str | None:
        for key, *values in _ATTRIBUTE.findall(self.attributes):
            if key.lower() == name:
                return unescape(next((v for v in values if v), ""))
        return None

    def hidden(self) -> bool:
        if self.tag in HIDDEN:
            return True
        if self.tag == "dialog" and self.get("open") is None:
            return True
        text = self.attributes
        if not text or not re.search("hidden|style", text, re.I):
            return False
        return (self.get("hidden") is not None or (self.get("aria-hidden") or "").lower() == "true"
                or bool(_GONE.search(self.get("style") or "")) or (self.tag == "input" and (self.get("type") or "").lower() == "hidden"))


def parse(html: str) -> Node:
    """The tree of a page; text nodes are strings."""
    root = Node("html")
    stack, at = [root], 0
    opened: Counter[str] = Counter()

    def text(data: str) -> None:
        if data:
            stack[-1].children.append(unescape(data) if "&" in data else data)

    def push(node: Node) -> None:
        if len(stack) >= DEPTH and not node.hidden():
            # What it holds goes to its parent, where the node itself leaves the borders of its lines only.
            node.children = stack[-1].children
            node.children.pop()
            if node.tag in BLOCK or node.tag in _PARTS:
                node.children.append(Node(_END))
        stack.append(node)
        opened[node.tag] += 1

    def close(tags, limits) -> None:
        if not any(opened[t] for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                while len(stack) > i:
                    node = stack.pop()
                    opened[node.tag] -= 1
                    if node.children is stack[-1].children and (node.tag in BLOCK or node.tag in _PARTS):
                        node.children.append(Node(_END))
                return
            if stack[i].tag in limits:
                return

    while at < len(html):
        mark = html.find("<", at)
        if mark < 0:
            text(html[at:])
            break
        found = _TOKEN.match(html, mark)
        if not found:  # a lone < is text
            text(html[at:mark + 1])
            at = mark + 1
            continue
        text(html[at:mark])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            if tag == "p" and not opened["p"]:
                stack[-1].children.append(Node("p"))
            elif tag == "br":
                stack[-1].children.append(Node("br"))
            else:
                close((tag,), () if tag == "table" else ("table",) if tag in _PARTS else _FENCE)
            continue
        if tag in BLOCK or tag in ("td", "th", "tr"):
            close(("p",), _FENCE)  # a block ends an open paragraph
        if tag in _CLOSES:
            close(*_CLOSES[tag])
        node = Node(tag, found[3])
        stack[-1].children.append(node)
        if tag in VOID or (found[3].endswith("/") and tag in ("svg", "path")):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            raw = html[at:end.start() if end else len(html)]
            node.children.append(unescape(raw) if tag in ("textarea", "title") else raw)
            at = end.end() if end else len(html)
            continue
        push(node)
    return root


def width(text: str) -> int:
    """Columns of a line: wide East Asian characters take two, combining marks none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Layout:
    """Lines under construction. gap: empty lines wanted before the next text."""

    def __init__(self):
        self.lines: list[str] = []
        self.line, self.gap, self.space = "", 0, False

    def words(self, data: str) -> None:
        parts = _SPACE.split(data)
        self.space |= not parts[0] and len(parts) > 1
        for i, part in enumerate(parts):
            if not part:
                continue
            if self.space and self.line and not self.line.endswith((" ", "\n")):
                self.line += " "
            self.line += part
            self.space = i < len(parts) - 1
        self.space |= not parts[-1] and len(parts) > 1

    def end(self, gap: int = 0) -> None:
        """Ends the line; the next text stands so many empty lines below."""
        if self.line.strip():
            if self.lines:
                self.lines.extend([""] * self.gap)
            self.lines.append(self.line.rstrip())
            self.gap = 0
        self.line, self.space = "", False
        self.gap = max(self.gap, gap)

    def block(self, lines: list[str], gap: int, first: str = "", rest: str = "") -> None:
        self.end(gap)
        for i, line in enumerate(lines):
            self.line = (first if not i else rest if line else "") + line
            if line or (not i and first):
                if self.lines:
                    self.lines.extend([""] * self.gap)
                self.lines.append(self.line.rstrip())
                self.gap = 0
            else:
                self.gap = max(self.gap, 1)
        self.line, self.gap = "", max(gap, 0)


def _inside(node: Node) -> list[str]:
    layout = Layout()
    _children(node, layout)
    layout.end()
    return layout.lines


def _span(cell: Node, name: str, left: int) -> int:
    """How many columns or rows a cell takes; 0 rows are all that are left of the group."""
    value = cell.get(name) or "1"
    if not value.isdigit():
        return 1
    return min(int(value), 1000) if int(value) else left if name == "rowspan" else 1


def _table(node: Node) -> list[str]:
    """Rows with their cells padded to the columns' widths. A cell that spans columns starts at its own, one that
    spans rows stands in its first; what is in a table or a row, but in no cell, comes before the table."""
    groups, lines = [[]], []

    def outside(part) -> None:
        if isinstance(part, str):
            if part.strip():
                lines.append(" ".join(part.split()))
        elif not part.hidden() and part.children:
            lines.extend(_inside(part))

    def walk(part: Node) -> None:
        for child in part.children:
            if isinstance(child, str) or child.hidden():
                outside(child)
            elif child.tag == "tr":
                cells = [c for c in child.children if isinstance(c, Node) and c.tag in ("td", "th")]
                for other in child.children:
                    if isinstance(other, str) or other.tag not in ("td", "th"):
                        outside(other)
                groups[-1].append(cells)
            elif child.tag in ("thead", "tbody", "tfoot"):
                groups.append([])
                walk(child)
                groups.append([])
            elif child.tag in ("td", "th"):  # cells without a row
                groups[-1].append([child])
            else:
                outside(child)

    walk(node)
    rows, widths = [], []
    for group in groups:
        taken: dict[int, int] = {}  # rows that a column is still taken for
        for r, row in enumerate(group):
            at, out, below = 0, [], {c: n - 1 for c, n in taken.items() if n > 1}
            for cell in row:
                while taken.get(at):
                    at += 1
                span, down = _span(cell, "colspan", 1), _span(cell, "rowspan", len(group) - r)
                # A hidden cell takes no place.
                if cell.hidden():
                    continue
                text = [x for x in _inside(cell) if x] or [""]
                out.append((at, text))
                if span == 1:
                    widths.extend([0] * (at + 1 - len(widths)))
                    widths[at] = max(widths[at], *(width(x) for x in text))
                if down > 1:
                    below.update(dict.fromkeys(range(at, at + span), down - 1))
                at += span
            taken = below
            rows.append(out)
    for out in rows:
        for i in range(max((len(text) for _, text in out), default=0)):
            line = ""
            for at, text in out:
                part = text[i] if i < len(text) else ""
                if at:
                    line += " " * max(0, sum(widths[:at]) + 3 * at - 3 - width(line)) + " | "
                line += part
            lines.append(line.rstrip())
    return lines


def _children(node: Node, layout: Layout) -> None:
    number = 1
    if node.tag == "ol" and (node.get("start") or "").lstrip("-").isdigit():
        number = int(node.get("start"))
    closed = node.tag == "details" and node.get("open") is None
    for child in node.children:
        if isinstance(child, str):
            if closed:
                continue
            if node.tag == "pre":
                for i, line in enumerate(child.split("\n")):
                    if i:  # empty lines in a row count as one
                        layout.end(0 if layout.line.strip() else 1)
                    layout.line += line
            else:
                layout.words(child)
            continue
        if child.hidden():
            continue
        tag = child.tag
        if closed and tag != "summary":
            continue
        if tag == _END:
            layout.end()
        elif tag == "br":
            had = bool(layout.line.strip())
            layout.end(0 if had else 1)
        elif tag == "img":
            layout.words(child.get("alt") or "")
        elif tag == "input":
            layout.words(" " + (child.get("value") or "") + " " if (child.get("type") or "").lower() in ("submit", "button", "reset") else "")
        elif tag == "table":
            layout.block(_table(child), 1)
        elif tag == "li":
            mark = f"{number}. " if node.tag == "ol" else "- "
            number += 1
            layout.block(_inside(child), 0, mark, " " * len(mark))
        elif tag in ("dd", "blockquote"):
            layout.block(_inside(child), int(tag in SPACED), "    ", "    ")
        elif tag in ("ul", "ol") and node.tag == "li":
            layout.block(_inside(child), 0)
        elif tag in BLOCK:
            layout.end(int(tag in SPACED))
            _children(child, layout)
            layout.end(int(tag in SPACED))
        elif tag in ("td", "th"):
            layout.words(" ")
            _children(child, layout)
            layout.words(" ")
        elif tag == "tr":
            layout.end()
            _children(child, layout)
            layout.end()
        else:
            _children(child, layout)


def render(html: str | None) -> str:
    """The visible text of a page; empty for null and for pages without any."""
    return "\n".join(_inside(parse(html or "")))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text, n_lines) of every page. Null and empty pages have empty text; repeated rows give as many rows; other
    columns are not read. Bytes that are not UTF-8 are read as U+FFFD."""
    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = [render((x.as_py() or b"").decode("utf-8", "replace")) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())],
                    ["page_id", "text", "n_lines"])

    source = pages.select(F.col(id_col).alias("page_id"), F.col(html_col).cast("binary").alias("html"))
    return source.mapInArrow(run, f"page_id {pages.schema[id_col].dataType.simpleString()}, text string, n_lines long")
