"""HTML extraction: all visible text, laid out.

Method: a tree builder with implied tags and visibility rules, and a renderer
that preserves block spacing, lists and aligned table cells.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lexmill.llm.common import packed, ship_package, unpacked

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript".split())
ESCAPABLE_RAW = frozenset("textarea title".split())
INVISIBLE = frozenset(
    "head title meta link base script style template noscript noembed noframes iframe object embed audio video canvas"
    " datalist area param source track defs desc metadata symbol annotation annotation-xml".split()
)
IN_HEAD = frozenset("base link meta title style script noscript template".split())
# Blocks with an empty line before and after, and blocks that only start a line.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dl pre xmp listing blockquote figure table hr fieldset".split())
PLAIN = frozenset(
    "html body div section article header footer nav main aside form address center details summary dialog figcaption"
    " li dt dd legend optgroup option caption tr hgroup search textarea".split()
)
CLOSES_P = (SPACED | PLAIN) - frozenset("html body optgroup option caption tr textarea legend".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol menu".split())
ROW_GROUPS = frozenset("thead tbody tfoot".split())
TABLE_PARTS = ROW_GROUPS | frozenset("caption colgroup col tr td th".split())
KEEPS_BLANKS = frozenset("pre xmp listing textarea".split())
# Start tags that end an open element: the elements, and those that hide them from the search.
_ENDED_BY = {
    "li": (frozenset(["li"]), LISTS),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "td": (frozenset(["td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "th": (frozenset(["td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "tr": (frozenset(["td", "th", "tr", "caption", "colgroup"]), frozenset(["table"])),
    "rt": (frozenset(["rt", "rp"]), frozenset(["ruby"])),
    "rp": (frozenset(["rt", "rp"]), frozenset(["ruby"])),
}
_ENDED_BY |= {
    group: (frozenset(["td", "th", "tr", "caption", "colgroup"]) | ROW_GROUPS, frozenset(["table"]))
    for group in (*ROW_GROUPS, "caption", "colgroup")
}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)"
    # A quote counts after an equals sign only. Possessive, so that no input is read twice.
    r"((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_HIDING = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.IGNORECASE)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)\b", re.IGNORECASE)
BULLETS = "-*+"
COLUMN_GAP = "  "
MAX_SPAN = 1000
# Cells of earlier rows that reach into a row, at most; further ones stand in their first row only.
MAX_REACHING = 100
# Layout must not multiply the input. Blanks that align the cells of a table are at most so many times its text and
# cells, and those of all tables so many times the page; columns are aligned up to a width that keeps to that.
PADDING = 8
CELL = 16
MAX_WIDTH = 400
MAX_INDENT = 80


class Node:
    """An element: its name, attributes and children, which are nodes or text."""

    __slots__ = ("attributes", "children", "tag")

    def __init__(self, tag: str, attributes: str = "") -> None:
        self.tag = tag
        self.attributes = attributes
        self.children: list[Node | str] = []

    def get(self, name: str) -> str | None:
        """The value of an attribute, empty if it has none; None without the attribute."""
        if name in self.attributes.lower():
            for key, *values in _ATTRIBUTE.findall(self.attributes):
                if key.lower() == name:
                    return html.unescape(next((v for v in values if v), ""))
        return None

    def number(self, name: str, default: int) -> int:
        value = (self.get(name) or "").strip()
        return int(value) if re.fullmatch(r"-?[0-9]{1,9}", value, re.ASCII) else default


def build_tree(source: str) -> Node:
    """The document as a tree under ``html``.

    Missing html, head, body, tbody and tr are implied, as are the ends of
    paragraphs, list items, rows, cells, options and headings. An end tag closes
    what is open inside its element; without an open element it is ignored, but
    for ``</p>`` and ``</br>``.
    """
    root = Node("html")
    body = Node("body")
    head = Node("head")
    root.children += [head, body]
    open_: list[Node] = [root, body]
    # How many elements of a name are open, so that none is searched for in vain.
    count: Counter[str] = Counter()

    def opened(node: Node) -> None:
        if node.tag not in VOID:
            open_.append(node)
            count[node.tag] += 1

    def pop_to(size: int) -> None:
        while len(open_) > size:
            count[open_.pop().tag] -= 1

    def push(tag: str, attributes: str = "") -> Node:
        node = Node(tag, attributes)
        open_[-1].children.append(node)
        opened(node)
        return node

    def close(wanted: frozenset[str], stop: frozenset[str], outermost: bool = False) -> bool:
        """Pop to the innermost open element of ``wanted``, or to the outermost, that no ``stop`` hides."""
        found = None
        if not any(count[tag] for tag in wanted):
            return False
        for i in range(len(open_) - 1, 1, -1):
            if open_[i].tag in stop:
                break
            if open_[i].tag in wanted:
                found = i
                if not outermost:
                    break
        if found is not None:
            pop_to(found)
        return found is not None

    cells = frozenset(["td", "th", "caption"])
    at = 0
    while at < len(source):
        mark = _MARKUP.search(source, at)
        if mark is None:
            open_[-1].children.append(html.unescape(source[at:]))
            break
        if mark.start() > at:
            open_[-1].children.append(html.unescape(source[at : mark.start()]))
        at = mark.end()
        if mark[2] is None:
            continue
        tag, attributes = mark[2].lower(), mark[3]
        if mark[1]:
            if tag == "br":
                push("br")
            elif tag == "p":
                if not close(frozenset(["p"]), cells | frozenset(["button", "table"])):
                    push("p")
                    pop_to(len(open_) - 1)
            elif tag in HEADINGS:
                close(HEADINGS, cells | frozenset(["table"]))
            elif tag == "table":
                close(frozenset(["table"]), frozenset())
            elif tag in TABLE_PARTS:
                close(frozenset([tag]), frozenset(["table"]))
            elif tag not in ("html", "body", "head"):
                # The end of an inline element does not reach out of a block cell.
                close(frozenset([tag]), cells | frozenset(["table"]))
            continue
        if tag in ("html", "body"):
            target = root if tag == "html" else body
            target.attributes += f" {attributes}"
            continue
        if tag == "head":
            continue
        if tag in CLOSES_P:
            close(frozenset(["p"]), cells | frozenset(["button", "table"]))
        if tag in HEADINGS and open_[-1].tag in HEADINGS:
            pop_to(len(open_) - 1)
        if tag in _ENDED_BY:
            close(*_ENDED_BY[tag], outermost=True)
        if tag in TABLE_PARTS and open_[-1].tag in ("table", *ROW_GROUPS, "tr"):
            if tag in ("td", "th", "tr") and open_[-1].tag == "table":
                push("tbody")
            if tag in ("td", "th") and open_[-1].tag != "tr":
                push("tr")
        if tag in IN_HEAD and len(open_) == 2 and not body.children:
            node = Node(tag, attributes)
            head.children.append(node)
            opened(node)
        else:
            node = push(tag, attributes)
        if tag in RAW or tag in ESCAPABLE_RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
            inner = source[at : end.start()] if end else source[at:]
            node.children.append(inner if tag in RAW else html.unescape(inner))
            pop_to(len(open_) - 1)
            at = end.end() if end else len(source)
        elif attributes.endswith("/") and tag in ("svg", "math"):
            pop_to(len(open_) - 1)
    return root


def is_hidden(node: Node, parent: Node | None) -> bool:
    """Whether the element and all inside it are invisible."""
    tag = node.tag
    if tag in INVISIBLE:
        return True
    if tag == "dialog" and node.get("open") is None:
        return True
    if parent is not None and parent.tag == "details" and tag != "summary" and parent.get("open") is None:
        return True
    if not node.attributes:
        return False
    if node.get("hidden") is not None or (tag == "input" and (node.get("type") or "").lower() == "hidden"):
        return True
    return _HIDING.search(node.get("style") or "") is not None


def is_shown(node: Node, inherited: bool) -> bool:
    """Whether text of the element shows, which a parent's ``visibility`` decides unless it has its own."""
    if not node.attributes:
        return inherited
    own = _VISIBILITY.findall(node.get("style") or "")
    return own[-1].lower() == "visible" if own else inherited


class Flow:
    """Lines of text under construction: collapses white space, and puts off line ends and empty lines until more comes."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = False
        self.gap = 0
        self.indent = [""]
        self.marker = ""

    def text(self, text: str) -> None:
        for i, word in enumerate(_BLANKS.split(text)):
            if i:
                self.space = True
            if word:
                if self.space and self.parts:
                    self.parts.append(" ")
                self.space = False
                self.parts.append(word)

    def line_end(self, margin: int = 0) -> None:
        """End the line, with ``margin`` empty lines before what follows."""
        if self.parts:
            self._put("".join(self.parts))
            self.parts = []
            self.gap = 0
        self.space = False
        self.gap = max(self.gap, margin)

    def break_line(self) -> None:
        if self.parts:
            self.line_end()
        else:
            self.gap += 1

    def _put(self, line: str) -> None:
        if self.lines:
            self.lines += [""] * self.gap
        prefix = self.indent[-1]
        if self.marker:
            prefix = prefix[: max(0, len(prefix) - len(self.marker))] + self.marker
            self.marker = ""
        self.lines.append((prefix + line).rstrip(" "))

    def verbatim(self, lines: list[str]) -> None:
        """Whole lines whose blanks stay."""
        self.line_end()
        for line in lines:
            self._put(line)
            self.gap = 0

    def done(self) -> list[str]:
        self.line_end()
        return self.lines


#: A cell: its lines, and the columns and rows that it spans.
Cell = tuple[list[str], int, int]


def _placed(rows: list[list[Cell]]) -> list[list[tuple[int, list[str], int]]]:
    """Each row's cells with the columns in which they start: beside cells of earlier rows that reach into it."""
    reaching: list[tuple[int, int, int]] = []
    out = []
    for y, row in enumerate(rows):
        reaching = [(start, end, until) for start, end, until in reaching if until > y]
        taken = sorted((start, end) for start, end, _ in reaching)
        at, k, placed = 0, 0, []
        for lines, columns, down in row:
            while k < len(taken) and taken[k][0] < at + columns:
                at, k = max(at, taken[k][1]), k + 1
            placed.append((at, lines, columns))
            if down > 1 and len(reaching) < MAX_REACHING:
                reaching.append((at, at + columns, y + down))
            at += columns
        out.append(placed)
    return out


def _grid(rows: list[list[Cell]], room: list[int]) -> list[str]:
    """Table rows as lines: cells of a column start at the same place, wide cells span columns.

    ``room`` holds the number of blanks that the page may still spend on that.
    """
    placed = _placed(rows)
    widths: dict[int, int] = {}
    texts = n_cells = 0

    def wide(lines: list[str]) -> int:
        return max(map(len, lines), default=0)

    for row in placed:
        for at, lines, span in row:
            if span == 1:
                widths[at] = max(widths.get(at, 0), wide(lines))
            texts += sum(map(len, lines))
            n_cells += 1
    for row in placed:
        for at, lines, span in row:
            if span > 1:
                need = wide(lines) - len(COLUMN_GAP) * (span - 1)
                have = sum(widths.get(at + k, 0) for k in range(span))
                widths[at + span - 1] = widths.get(at + span - 1, 0) + max(0, need - have)
    columns = max((at + span for row in placed for at, _, span in row), default=0)
    heights = [max((len(lines) for _, lines, _ in row), default=0) for row in placed]
    # Nothing is padded behind a row's last cell.
    before = sum(len(line) for row in placed for _, lines, _ in row[:-1] for line in lines)
    reach = [max((at for at, _, _ in row), default=0) for row in placed]
    limit = min(room[0], PADDING * (texts + CELL * n_cells))
    most = min(MAX_WIDTH, max(widths.values(), default=0))
    while True:
        # Where the columns start, if none is wider than that.
        starts = [0]
        for c in range(columns):
            starts.append(starts[-1] + min(most, widths.get(c, 0)) + len(COLUMN_GAP))
        cost = sum(starts[r] * h for r, h in zip(reach, heights, strict=True)) - before
        if cost <= limit or not most:
            break
        most //= 2
    aligned = cost <= limit
    room[0] -= max(0, cost) if aligned else 0
    out = []
    for row, height in zip(placed, heights, strict=True):
        for k in range(height):
            line = ""
            for at, lines, _ in row:
                if aligned:
                    line = line.ljust(starts[at])
                if line and not line.endswith(COLUMN_GAP):
                    line = line.rstrip(" ") + COLUMN_GAP
                line += lines[k] if k < len(lines) else ""
            out.append(line.rstrip(" "))
    return out


class _List:
    """An open list: whether it is numbered, the next number, and its bullet."""

    def __init__(self, node: Node, depth: int) -> None:
        self.ordered = node.tag == "ol"
        self.next = node.number("start", 1)
        self.bullet = BULLETS[depth % len(BULLETS)]


def render(root: Node, size: int) -> str:
    """The visible text of the tree of a page of ``size`` characters.

    Elements are entered and left with a stack of their own, so any depth will do.
    """
    room = [PADDING * size]
    flows = [Flow()]
    lists: list[_List] = []
    tables: list[list[list[Cell]]] = []
    verbatim = 0
    stack: list[tuple[Node | str, Node | None, bool, bool]] = [(root, None, False, True)]
    while stack:
        node, parent, leaving, shown = stack.pop()
        flow = flows[-1]
        if isinstance(node, str):
            if not shown:
                continue
            if parent is not None and parent.tag in ("table", "tr", *ROW_GROUPS) and not node.strip():
                continue
            if parent is not None and parent.tag == "details" and parent.get("open") is None:
                continue
            if verbatim:
                first, *more = node.replace("\r\n", "\n").split("\n")
                flow.parts.append(first)
                for line in more:
                    flow.parts = flow.parts or [""]
                    flow.line_end()
                    flow.parts.append(line)
            else:
                flow.text(node)
            continue
        tag = node.tag
        margin = 1 if tag in SPACED and not (tag in LISTS and lists) else 0
        cell = tag in ("td", "th") and tables
        if not leaving:
            if is_hidden(node, parent):
                continue
            shown = is_shown(node, shown)
            if tag == "br":
                flow.break_line()
                continue
            if tag == "wbr" or tag == "input":
                continue
            if cell:
                if not tables[-1]:
                    tables[-1].append([])
                flows.append(Flow())
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in SPACED or tag in PLAIN:
                flow.line_end(margin)
            if tag == "hr":
                flow.verbatim(["---"] if shown else [])
                flow.line_end(1)
                continue
            if tag in LISTS:
                lists.append(_List(node, len(lists)))
            elif tag == "li":
                here = lists[-1] if lists else None
                if here is not None and here.ordered:
                    here.next = node.number("value", here.next)
                    marker = f"{here.next}. "
                    here.next += 1
                else:
                    marker = f"{here.bullet if here else BULLETS[0]} "
                deeper = " " * len(marker) if len(flow.indent[-1]) < MAX_INDENT else ""
                flow.indent.append(flow.indent[-1] + deeper)
                flow.marker = marker if shown else ""
            elif tag in ("blockquote", "dd"):
                flow.indent.append(flow.indent[-1] + ("    " if len(flow.indent[-1]) < MAX_INDENT else ""))
            elif tag == "table":
                tables.append([])
            elif tag in KEEPS_BLANKS:
                verbatim += 1
                if node.children and isinstance(node.children[0], str):
                    node.children[0] = node.children[0].removeprefix("\n")
            stack.append((node, parent, True, shown))
            stack += [(child, node, False, shown) for child in reversed(node.children)]
            continue
        if cell:
            done = flows.pop().done()
            spans = [max(1, node.number(name, 1)) for name in ("colspan", "rowspan")]
            tables[-1][-1].append((done, min(MAX_SPAN, spans[0]), spans[1]))
        elif tag == "table" and tables:
            rows = tables.pop()
            # A caption, or what stands between the rows, is in the flow by now and comes first.
            flow.line_end()
            flow.verbatim(_grid(rows, room))
            flow.line_end(1)
        elif tag in KEEPS_BLANKS:
            verbatim -= 1
            if flow.parts == [""]:
                flow.parts = []
            flow.line_end(margin)
        elif tag in LISTS:
            lists.pop()
            flow.line_end(0 if lists else 1)
        elif tag in ("li", "blockquote", "dd"):
            flow.line_end(margin)
            flow.indent.pop()
            flow.marker = ""
        elif (tag in SPACED or tag in PLAIN) and not (tag == "tr" and tables):
            flow.line_end(margin)
    return "\n".join(flows[0].done())


def visible_text(source: str) -> str:
    return render(build_tree(source), len(source))


@F.pandas_udf(StringType())
def _rendered(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series([visible_text(source) for source in batch], dtype=object)


def extracted(pages: DataFrame, *, source: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``out`` in place of ``source``: the visible text of each page, laid out.

    Blocks start on lines of their own, paragraphs, headings, lists, tables and
    quotes have an empty line around them. List items have a bullet or their
    number and are indented by depth, cells of a table column are aligned, and
    preformatted text keeps its blanks. Not visible are the head, scripts,
    styles, templates and embedded media, elements with ``hidden``,
    ``display: none``, closed dialogs, closed details but for their summary, and
    what ``visibility: hidden`` hides but for visible elements in it. Cells keep
    beside those that span rows. Alignment stops where its blanks would exceed
    PADDING times the text of the table or the page.

    Null and empty pages give an empty text; any string is HTML, malformed or
    not, of any length and depth. Repeated rows come out alike, an empty table
    gives an empty table, and an input column named as ``out`` is replaced.
    """
    ship_package(pages.sparkSession)
    rows = packed(pages, _rendered(F.coalesce(F.col(f"`{source}`"), F.lit(""))).alias("rendered"))
    names = [c for c in pages.columns if c != source]
    return rows.select(*unpacked(rows, names, {out: F.col("rendered")}))
