"""Visible text of HTML pages, laid out as lines.

A page is read into a tree (tags that may be left out are implied), then rendered: hidden parts
are skipped, blocks start new lines, paragraphs and lists are set apart, list items have their
marks, preformatted text keeps its blanks, and the cells of a table stand in columns.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportweave.llm.batches import slices
from reportweave.sources.tables import read_table

MAX_DEPTH = 100  # deeper elements become siblings, as in browsers
TABLE_DEPTH = 4  # by which the parts of a table may be deeper, so that its cells stay in place
MAX_SPAN = 1_000  # columns or rows that one cell may cover
PAD_WIDTH = 60  # longer cells do not widen their column

# Element names of HTML, by how they are laid out or parsed.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
UNSEEN = frozenset(
    "script style title iframe noembed noframes noscript head template datalist audio video canvas"
    " object area base col colgroup embed link meta param source track rp".split()
)
SPACED = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr fieldset menu dir xmp listing".split()
)
BLOCK = SPACED | frozenset(
    "address article aside body caption center dd details dialog div dt figcaption footer form"
    " header hgroup html legend li main nav option search section summary tbody td tfoot th thead"
    " tr optgroup".split()
)
ENDS_PARAGRAPH = BLOCK - {"option", "optgroup", "caption", "legend", "body", "html"}
KEEPS_BLANKS = frozenset("pre textarea listing xmp".split())
# What a start tag ends, and the elements it does not reach beyond.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th", "caption"}, {"tr", "table"}),
    "th": ({"td", "th", "caption"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
}
GROUPS = frozenset("tbody thead tfoot".split())
TABLE_PARTS = GROUPS | {"table", "tr"}
# What a table tag goes straight into; anything open inside of that is closed.
TABLE_PARENTS = dict.fromkeys(GROUPS, {"table"}) | {
    "tr": GROUPS | {"table"}, "td": TABLE_PARTS, "th": TABLE_PARTS,
}
# Drawings and formulas: what is not shown, what holds HTML again, and the HTML that ends them.
FOREIGN_UNSEEN = {
    "svg": frozenset(
        "defs desc metadata symbol clippath mask pattern marker lineargradient radialgradient filter".split()
    ),
    "math": frozenset("annotation annotation-xml mphantom".split()),
}
SVG_TEXT = frozenset({"text", "foreignobject"})
HOLDS_HTML = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu"
    " meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
CELL_WALLS = frozenset({"td", "th", "caption", "table", "html"})

_MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+>?"
    r"|</(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+>?"
    r"|<(?P<start>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[\s/]++|[^\s/>][^\s/>=]*+"
    r"(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?)?)*+)>?",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s>\"'][^\s>]*+)))?"
)
_DECLARATION = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
_SELECTOR = re.compile(r"(\*|[a-z][\w-]*)?((?:[.#][\w-]+)*)", re.I)
_CSS_STEP = re.compile(r"[{}]|;|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)")
# Inputs that show no text of theirs.
UNSEEN_INPUTS = frozenset("hidden password checkbox radio file image range color".split())
_BLANKS = re.compile(r"[ \t\n\r\f]+")


@dataclass
class Node:
    tag: str
    attributes: dict[str, str]
    hidden: bool
    unseen: bool = False  # takes part in the layout, but its text is not shown
    tight: bool = False  # a list in a list item, which is not set apart
    foreign: str = ""  # svg or math, for an element of a drawing or a formula
    mute: bool = False  # its own text is not shown, its elements are
    children: list[Node | str] = field(default_factory=list)


# ---------------------------------------------------------------- tree


def _attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, one, two, bare in _ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), html.unescape(one or two or bare))
    return found


def _hides(tag: str, attributes: dict[str, str]) -> bool:
    return (
        tag in UNSEEN
        or "hidden" in attributes
        or (tag == "input" and attributes.get("type", "").strip().lower() in UNSEEN_INPUTS)
        or (tag == "dialog" and "open" not in attributes)
    )


def _hides_foreign(kind: str, tag: str, attributes: dict[str, str]) -> bool:
    return tag in FOREIGN_UNSEEN[kind] or (
        kind == "svg" and attributes.get("display", "").strip().lower() == "none"
    )


def _declared(body: str) -> dict[str, tuple[bool, str]]:
    """Whether it is important, and the value, of what a style says about display and visibility."""
    found: dict[str, tuple[bool, str]] = {}
    for name, value, important in _DECLARATION.findall(body):
        name = name.lower()
        if important or not found.get(name, (False,))[0]:
            found[name] = (bool(important), value.lower())
    return found


class Sheet:
    """Rules about display and visibility whose selector is a tag, classes and an id.

    Rules with other selectors, and those for other media than screens, are left out.
    """

    def __init__(self) -> None:
        self.rules: dict[str, list[tuple]] = {}
        self.order = 0

    def add(self, css: str) -> None:
        css = re.sub(r"/\*.*?(?:\*/|\Z)", " ", css, flags=re.S)
        blocks: list[bool] = []  # of the open at-rules, whether they hold for a screen
        begin = at = 0
        head: str | None = None
        while found := _CSS_STEP.search(css, at):
            at = found.end()
            sign = found[0]
            if sign == "{" and head is None:
                name = css[begin : found.start()].strip()
                if name.startswith("@"):
                    words = name.lower().split(None, 1)
                    medium = words[1].strip() if len(words) > 1 else ""
                    blocks.append(words[0] == "@media" and medium in ("", "all", "screen", "only screen"))
                else:
                    head = name
                begin = at
            elif sign == "}":
                if head is not None:
                    if all(blocks):
                        self._rule(head, css[begin : found.start()])
                    head = None
                elif blocks:
                    blocks.pop()
                begin = at
            elif sign == ";" and head is None:
                begin = at

    def _rule(self, selectors: str, body: str) -> None:
        declared = _declared(body)
        if not declared:
            return
        for selector in selectors.split(","):
            found = _SELECTOR.fullmatch(selector.strip())
            if found is None or not found[0]:
                continue
            tag = "" if found[1] in (None, "*") else found[1].lower()
            parts = re.findall(r"[.#][\w-]+", found[2])
            ids = frozenset(p for p in parts if p[0] == "#")
            classes = frozenset(p for p in parts if p[0] == ".")
            key = min(ids or classes, default=tag)
            self.order += 1
            weight = (len(ids), len(classes), bool(tag), self.order)
            self.rules.setdefault(key, []).append((weight, tag, ids | classes, declared))

    def apply(self, node: Node) -> dict[str, str]:
        """The values of display and visibility that the sheet and its own style give an element."""
        found: list[tuple[tuple, dict[str, tuple[bool, str]]]] = []
        if self.rules:
            own = {f".{c}" for c in node.attributes.get("class", "").split()}
            if name := node.attributes.get("id"):
                own.add(f"#{name}")
            for key in {"", node.tag, *own}:
                for weight, tag, parts, declared in self.rules.get(key, ()):
                    if tag in ("", node.tag) and parts <= own:
                        found.append((weight, declared))
        if style := node.attributes.get("style"):
            found.append(((1_000_000,), _declared(style)))
        values: dict[str, str] = {}
        for name in ("display", "visibility"):
            said = [(d[name][0], weight, d[name][1]) for weight, d in found if name in d]
            if said:
                values[name] = max(said)[2]
        return values


def _settle(root: Node) -> None:
    """Marks what the styles of a page hide: with all it holds by display, by visibility except for
    what says that it is visible."""
    sheet = Sheet()
    todo = [root]
    while todo:
        node = todo.pop()
        if node.tag == "style" and not node.foreign:
            sheet.add("".join(c for c in node.children if isinstance(c, str)))
        # Rules are read in the order of the page.
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node) and c.tag != "template")
    todo = [root]
    while todo:
        node = todo.pop()
        for child in node.children:
            if not isinstance(child, Node):
                continue
            values = sheet.apply(child)
            child.hidden = child.hidden or node.hidden or values.get("display") == "none"
            said = values.get("visibility")
            if said is None and child.foreign == "svg":
                said = child.attributes.get("visibility", "").strip().lower()
            if said in ("hidden", "collapse", "visible"):
                child.unseen = said != "visible"
            else:
                child.unseen = node.unseen
            if not child.hidden:
                todo.append(child)


def _closes_itself(raw: str) -> bool:
    """Whether a tag ends with a slash that is not the end of an unquoted value."""
    if not raw.endswith("/"):
        return False
    last = None
    for last in _ATTRIBUTE.finditer(raw):
        pass
    return last is None or last.end() < len(raw)


class TreeBuilder:
    def __init__(self) -> None:
        self.root = Node("html", {}, False)
        self.open = [self.root]

    def _pop_to(self, tags: set[str] | frozenset[str], walls: set[str] | frozenset[str]) -> None:
        """Closes the outermost open element of ``tags`` above the nearest of ``walls``."""
        cut = None
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in walls:
                break
            if self.open[i].tag in tags:
                cut = i
        if cut is not None:
            del self.open[cut:]

    def _push(self, tag: str, attributes: dict[str, str]) -> None:
        while len(self.open) >= MAX_DEPTH and (
            len(self.open) >= MAX_DEPTH + TABLE_DEPTH
            or self.open[-1].tag not in TABLE_PARTS | {"td", "th"}
        ):
            if self.open[-1].hidden and not self.open[-2].hidden:
                break  # what is in it must stay hidden
            self.open.pop()
        parent = self.open[-1]
        tight = tag in ("ul", "ol") and any(n.tag == "li" for n in self.open)
        own = _declared(attributes["style"]) if "style" in attributes else {}
        hides = _hides(tag, attributes) or own.get("display", (False, ""))[1] == "none"
        node = Node(tag, attributes, parent.hidden or hides, tight=tight)
        node.foreign = tag if tag in FOREIGN_UNSEEN else "" if parent.tag in HOLDS_HTML else parent.foreign
        if node.foreign:
            node.hidden = node.hidden or _hides_foreign(node.foreign, tag, attributes)
            inside = parent.foreign == "svg" and not parent.mute and parent.tag not in HOLDS_HTML
            node.mute = node.foreign == "svg" and tag not in SVG_TEXT and not inside
        parent.children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def in_foreign(self) -> bool:
        return bool(self.open[-1].foreign) and self.open[-1].tag not in HOLDS_HTML

    def start(self, tag: str, raw: str) -> None:
        if tag in ("html", "body") and len(self.open) > 1 and any(n.tag == tag for n in self.open):
            return
        if tag == "html":
            return
        if tag in ENDS_FOREIGN:
            while self.in_foreign():
                self.open.pop()
        if tag in ENDS_PARAGRAPH:
            self._pop_to({"p"}, CELL_WALLS)
        if tag not in ("title", "meta", "link", "style", "script", "base", "noscript", "template", "head"):
            self._pop_to({"head"}, set())
        if tag in IMPLIED_END:
            ends, walls = IMPLIED_END[tag]
            self._pop_to(ends, walls)
            parents = TABLE_PARENTS.get(tag, ())
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag in parents:
                    del self.open[i + 1 :]
                    break
            here = self.open[-1].tag
            if tag in ("td", "th") and here == "table":
                self._push("tr", {})
            elif tag in ("td", "th") and here in ("tbody", "thead", "tfoot"):
                self._push("tr", {})
        alone = tag == "form" and self.open[-1].tag in TABLE_PARTS  # holds nothing, as in browsers
        self._push(tag, _attributes(raw) if raw else {})
        if alone and self.open[-1].tag == "form":
            self.open.pop()

    def end(self, tag: str) -> None:
        if tag in ("html", "body") or tag in VOID:
            if tag == "br":
                self._push("br", {})
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in ("td", "th", "table") and tag not in ("table", "tr", "tbody", "thead", "tfoot"):
                break  # an end tag in a cell closes nothing outside it
        if tag == "p" and not self.in_foreign():
            self._push("p", {})
            if self.open[-1].tag == "p":
                self.open.pop()

    def text(self, text: str) -> None:
        if text:
            if self.open[-1].tag == "head" and text.strip():
                self.open.pop()
            self.open[-1].children.append(text)


def parse(page: str) -> Node:
    """The tree of a page; any string is accepted."""
    builder = TreeBuilder()
    at = 0
    low = None
    while at < len(page):
        found = _MARKUP.search(page, at)
        if found is None:
            builder.text(html.unescape(page[at:]))
            break
        builder.text(html.unescape(page[at : found.start()]))
        at = found.end()
        if tag := found["end"]:
            builder.end(tag.lower())
        elif tag := found["start"]:
            tag = tag.lower()
            builder.start(tag, found["rest"])
            if builder.open[-1].foreign and builder.open[-1].tag == tag and _closes_itself(found["rest"]):
                builder.open.pop()
            elif tag in RAW:
                low = page.lower() if low is None else low
                if len(low) != len(page):  # a few letters change length when lowered
                    low = re.sub("[A-Z]", lambda m: m[0].lower(), page)
                stop = low.find(f"</{tag}", at)
                stop = len(page) if stop < 0 else stop
                body = page[at:stop]
                builder.text(html.unescape(body) if tag in ("textarea", "title") else body)
                at = stop
        elif builder.in_foreign() and page.startswith("<![CDATA[", found.start()):
            stop = page.find("]]>", found.start())
            stop = len(page) if stop < 0 else stop
            builder.text(page[found.start() + len("<![CDATA[") : stop])
            at = stop + len("]]>")
    _settle(builder.root)
    return builder.root


# ---------------------------------------------------------------- layout


class Flow:
    """Lines under construction."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = False
        self.gap = False

    def _place(self, text: str) -> None:
        if self.gap and not self.parts:
            if self.lines and self.lines[-1]:
                self.lines.append("")
            self.gap = False
        self.parts.append(text)

    def text(self, text: str) -> None:
        """Text with blanks folded; a blank at either end may join what is around it."""
        words = _BLANKS.sub(" ", text)
        if words[0] == " ":
            self.space = True
            words = words[1:]
        if not words:
            return
        ends = words[-1] == " "
        if self.space and self.parts:
            self.parts.append(" ")
        self._place(words[:-1] if ends else words)
        self.space = ends

    def kept(self, text: str) -> None:
        """Text whose blanks and line ends stay."""
        first, *rest = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        if first:
            self._place(first)
        for line in rest:
            self.end_line(always=True)
            if line:
                self._place(line)

    def end_line(self, always: bool = False) -> None:
        if self.parts or always:
            self.lines.append("".join(self.parts).rstrip(" "))
        self.parts, self.space = [], False

    def apart(self) -> None:
        self.end_line()
        self.gap = True

    def add(self, lines: list[str]) -> None:
        """Lines of a part that was laid out by itself."""
        self.end_line()
        for line in lines:
            if line:
                self._place(line)
            self.end_line(always=True)

    def done(self) -> list[str]:
        self.end_line()
        lines = self.lines
        while lines and not lines[-1]:
            lines.pop()
        return lines


def _apart(node: Node) -> list[str]:
    flow = Flow()
    _children(node, flow)
    return flow.done()


def _children(node: Node, flow: Flow, keeps: bool = False) -> None:
    for child in node.children:
        if isinstance(child, str):
            if not node.hidden and not node.mute and not node.unseen:
                (flow.kept if keeps else flow.text)(child)
        else:
            _element(child, flow, keeps)


def _element(node: Node, flow: Flow, keeps: bool) -> None:
    tag = node.tag
    if node.hidden:
        return
    keeps = keeps or tag in KEEPS_BLANKS
    if tag == "br":
        flow.end_line(always=True)
    elif tag == "input":
        value = "" if node.unseen else node.attributes.get("value", "")
        flow.text(f" {value} ")  # a box of its own
    elif tag in ("td", "th", "mtd"):  # outside a table
        flow.text(" ")
        _children(node, flow, keeps)
        flow.text(" ")
    elif node.foreign == "svg" and tag in SVG_TEXT:
        flow.end_line()
        _children(node, flow, keeps)
        flow.end_line()
    elif tag not in BLOCK:
        _children(node, flow, keeps)
    else:
        edge = flow.apart if tag in SPACED and not node.tight else flow.end_line
        edge()
        if tag in ("ul", "ol", "menu", "dir"):
            _list(node, flow)
        elif tag == "table":
            _table(node, flow)
        elif tag == "details" and "open" not in node.attributes:
            for child in node.children:
                if isinstance(child, Node) and child.tag == "summary":
                    _element(child, flow, keeps)
        elif tag == "dd" or tag == "blockquote":
            flow.add([f"  {line}" if line else "" for line in _apart(node)])
        elif tag == "li":  # outside a list
            flow.add(_item("- ", node))
        else:
            if tag == "optgroup" and not node.unseen and node.attributes.get("label", "").strip():
                flow.text(node.attributes["label"])
                flow.end_line()
            if tag == "pre" and node.children and isinstance(node.children[0], str):
                node.children[0] = node.children[0].removeprefix("\n")
            _children(node, flow, keeps)
        edge()


def _item(mark: str, node: Node) -> list[str]:
    lines = _apart(node) or [""]
    while len(lines) > 1 and not lines[0]:
        lines = lines[1:]
    rest = [f"{' ' * len(mark)}{line}" if line else "" for line in lines[1:]]
    return [f"{mark}{lines[0]}".rstrip(), *rest]


def _width(line: str) -> int:
    """Columns that a line takes where wide characters take two and marks none."""
    if line.isascii():
        return len(line)
    return sum(
        0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in ("W", "F") else 1 for c in line
    )


def _whole(value: str | None, default: int) -> int:
    found = re.match(r"\s*(-?\d{1,6})", value or "")
    return int(found[1]) if found else default


def _list(node: Node, flow: Flow) -> None:
    """Items with a dash, or with their numbers; anything else in the list stays in place."""
    ordered = node.tag == "ol"
    number = _whole(node.attributes.get("start"), 1)
    for child in node.children:
        if isinstance(child, str):
            if child.strip() and not node.unseen:
                flow.text(child)
        elif child.tag != "li":
            _element(child, flow, False)
        elif not child.hidden:
            number = _whole(child.attributes.get("value"), number)
            item = _item(f"{number}. " if ordered else "- ", child)
            if not child.unseen or len(item) > 1 or " " in item[0].lstrip():
                flow.add(item)
            number += 1


def _rows(node: Node) -> Iterator[Node]:
    for child in node.children:
        if isinstance(child, Node) and not child.hidden:
            if child.tag == "tr":
                yield child
            elif child.tag in GROUPS:
                yield from _rows(child)


def _strays(node: Node) -> Iterator[Node | str]:
    """What stands in a table or its parts but is no part of it."""
    for child in node.children:
        if isinstance(child, str):
            if child.strip() and not node.hidden and not node.unseen:
                yield child
        elif child.tag == "tr" or child.tag in GROUPS:
            yield from _strays(child)
        elif not (child.tag == "caption" and node.tag == "table" or child.tag in ("td", "th") and node.tag == "tr"):
            yield child


def _table(node: Node, flow: Flow) -> None:
    """What does not belong into a table first, as in browsers, then captions, then rows of cells
    padded to the width of their column."""
    for child in _strays(node):
        if isinstance(child, str):
            flow.text(child)
        else:
            _element(child, flow, False)
    flow.end_line()
    for child in node.children:
        if isinstance(child, Node) and child.tag == "caption":
            _element(child, flow, False)
    flow.end_line()
    grid: list[list[tuple[int, list[str], int]]] = []  # column, lines, columns covered
    taken: dict[int, int] = {}  # column: rows it is still covered from above
    for row in _rows(node):
        cells, column = [], 0
        covered = set(taken)
        taken = {c: n - 1 for c, n in taken.items() if n > 1}
        for cell in row.children:
            if not isinstance(cell, Node) or cell.tag not in ("td", "th") or cell.hidden:
                continue
            while column in covered:
                column += 1
            width = max(1, min(MAX_SPAN, _whole(cell.attributes.get("colspan"), 1)))
            height = max(1, min(MAX_SPAN, _whole(cell.attributes.get("rowspan"), 1)))
            cells.append((column, _apart(cell), width))
            if height > 1:
                taken |= {c: height - 1 for c in range(column, column + width)}
            column += width
        if any(lines for _, lines, _ in cells):
            grid.append(cells)
    widths: dict[int, int] = {}
    for cells in grid:
        for column, lines, span in cells:
            longest = max(map(_width, lines), default=0)
            if span == 1 and longest <= PAD_WIDTH:
                widths[column] = max(widths.get(column, 0), longest)
    starts, at = {}, 0
    for column in range(max((c for cells in grid for c, _, _ in cells), default=-1) + 1):
        starts[column] = at
        at += widths[column] + 2 if widths.get(column) else 0
    for cells in grid:
        height = max(len(lines) for _, lines, _ in cells)
        for i in range(height):
            line = ""
            for column, lines, _ in cells:
                part = lines[i] if i < len(lines) else ""
                if part:
                    taken_up = _width(line)
                    line += " " * (2 if taken_up > max(starts[column] - 2, 0) else starts[column] - taken_up)
                    line += part
            flow.add([line.rstrip()])


def render(page: str | None) -> str:
    """All visible text of a page; nothing for a null or empty page."""
    if not page:
        return ""
    lines = _apart(parse(page))
    text = "\n".join(lines).replace("\xa0", " ").replace("\xad", "").replace("\x00", "")
    return re.sub(r"\n{3,}", "\n\n", text).strip("\n")


# ---------------------------------------------------------------- Spark


def extract_text(
    pages: DataFrame, id: str = "page_id", page: str = "html", out: str = "text"
) -> DataFrame:
    """``id, out`` with the visible text of every row of ``pages``.

    A null, empty or wholly hidden page gives an empty text. Broken markup is read as browsers
    do: what is left open is closed, what is unknown is inline. What styles and sheets hide is left
    out, as far as their rules name tags, classes and ids and hold for a screen. Repeated rows are rendered each;
    other columns are ignored; pages are read whole.
    """
    rows = pages.select(F.col(id), F.col(page).alias("_page"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                texts = pa.array([render(p) for p in batch[1].to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([batch[0], texts], [id, out])

    kind = rows.schema[id].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id}` {kind}, `{out}` string")


def op7_html_text(spark: SparkSession, sf: str) -> DataFrame:
    found = extract_text(read_table(spark, sf, "pages"))
    return found.select("page_id", "text", F.length("text").cast("bigint").alias("n_chars"))
