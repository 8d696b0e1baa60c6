"""Layout-aware rendering of web pages: a small tree builder and a text renderer."""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_left
from collections import defaultdict
from functools import lru_cache
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import map_rows

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template noscript title datalist iframe object audio video canvas".split())
#: Elements of drawings and formulas that are not shown, and those whose parts are set apart by a blank.
UNSEEN_IN = {"svg": frozenset("desc metadata defs symbol".split()), "math": frozenset("annotation annotation-xml".split())}
APART = frozenset("mfrac mtable mtr".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary table ul
    tr thead tbody tfoot caption td th option optgroup""".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre table blockquote figure".split())
CLOSES_P = BLOCK - frozenset("html body tr thead tbody tfoot caption td th option optgroup legend summary dd dt li".split()) | {"hr"}
#: A start tag ends these open elements, looked for up to the elements named after them.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, {"body"}),
}
#: An end tag does not reach beyond these.
BARRIERS = frozenset(("table", "td", "th", "caption", "html"))
TABLE_PARTS = frozenset(("table", "tr", "thead", "tbody", "tfoot"))
#: Most columns and rows that a cell spans in HTML.
MOST_COLUMNS, MOST_ROWS = 1000, 65534
#: A table whose blanks for alignment would be over this many times its text, and over that many, is written without them.
PADDING, LEAST_PADDING = 32, 1 << 16

_TAG = re.compile(r"<(?:!--(?P<c>.*?)(?:-->|$)|[!?](?P<d>[^>]*)>?|(?P<e>/)?(?P<n>[a-zA-Z][^\s/>]*)(?P<a>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|$))", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_UNSEEN = re.compile(r"display\s*:\s*none", re.IGNORECASE)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.IGNORECASE)
_SPACE = re.compile(r"[ \t\r\n\f]+")


class Node:
    __slots__ = ("attributes", "children", "name")

    def __init__(self, name: str, attributes: dict[str, str] | None = None):
        self.name, self.attributes, self.children = name, attributes or {}, []

    def hidden(self) -> bool:
        a = self.attributes
        return (self.name in HIDDEN or "hidden" in a or bool(_UNSEEN.search(a.get("style", "")))
                or (self.name == "dialog" and "open" not in a))


class Open:
    """The open elements with their places by name and those of the barriers, so that no search walks down the stack."""

    def __init__(self, root: Node):
        self.nodes: list[Node] = []
        self.places: dict[str, list[int]] = defaultdict(list)
        self.barriers: list[int] = []
        self.push(root)

    def push(self, node: Node) -> None:
        self.places[node.name].append(len(self.nodes))
        if node.name in BARRIERS:
            self.barriers.append(len(self.nodes))
        self.nodes.append(node)

    def last(self, names) -> int:
        """The place of the innermost open element of these names; 0, that of the root, if there is none."""
        return max((self.places[n][-1] for n in names if self.places[n]), default=0)

    def cut(self, at: int) -> None:
        for node in self.nodes[at:]:
            self.places[node.name].pop()
        del self.nodes[at:]
        while self.barriers[-1] >= at:
            self.barriers.pop()

    def close(self, name: str) -> None:
        """End the innermost element of that name, if no barrier stands before it."""
        at = self.last((name,))
        if at and (name in TABLE_PARTS or self.barriers[-1] <= at):
            self.cut(at)

    def imply(self, ends: set[str], limit: set[str]) -> None:
        """End open elements of these names up to the innermost of the limit."""
        least = self.last(limit)
        while (at := self.last(ends)) > least:
            self.cut(at)


def parse(page: str) -> Node:
    """The tree of a page; end tags that are left out are implied by what follows, stray ones are ignored."""
    root = Node("html")
    stack, at = Open(root), 0
    while at < len(page):
        lt = page.find("<", at)
        match = _TAG.match(page, lt) if lt >= 0 else None
        if lt > at or lt < 0:
            stack.nodes[-1].children.append(html.unescape(page[at:lt if lt >= 0 else len(page)]))
        if lt < 0:
            break
        if match is None:
            stack.nodes[-1].children.append("<")
            at = lt + 1
            continue
        at = match.end()
        name = (match["n"] or "").lower()
        if not name:
            continue
        if match["e"]:
            stack.close(name)
            continue
        foreign = next((n for n in ("svg", "math") if name == n or stack.places[n]), None)
        attributes = {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(match["a"])} if match["a"].strip(" /") else {}
        if name in ("html", "body") and stack.places[name]:
            continue
        if name in CLOSES_P:
            stack.close("p")
        if name in IMPLIED:
            stack.imply(*IMPLIED[name])
        node = Node(name, attributes)
        if foreign and name in UNSEEN_IN[foreign]:
            node.attributes["hidden"] = ""
        stack.nodes[-1].children.append(node)
        if foreign and match["a"].endswith("/"):
            continue
        if name in RAW:
            close = re.compile(f"</{re.escape(name)}\\s*>", re.IGNORECASE).search(page, at)
            raw = page[at:close.start() if close else len(page)]
            node.children.append(html.unescape(raw) if name == "textarea" else raw)
            at = close.end() if close else len(page)
        elif name not in VOID:
            stack.push(node)
    return root


def settle(root: Node) -> None:
    """Take out what is invisible by style; an element inherits it, and a visible one below an invisible one stays."""
    order, at = [[root, True]], 0
    while at < len(order):
        node, seen = order[at]
        if found := _VISIBILITY.findall(node.attributes.get("style", "")):
            order[at][1] = seen = found[-1].lower() == "visible"
        order.extend([c, seen] for c in node.children if isinstance(c, Node))
        at += 1
    gone = set()
    for node, seen in reversed(order):
        node.children = [c for c in node.children if (seen if isinstance(c, str) else id(c) not in gone)]
        if not seen:
            if not node.children:
                gone.add(id(node))
            elif node.name == "li":  # its mark is invisible too
                node.name = "div"


class Writer:
    """Lines of text; white space between words is one blank, blank lines stand between spaced blocks."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.blank = False

    def words(self, text: str) -> None:
        text = _SPACE.sub(" ", text)
        if self.line and self.line[-1].endswith(" ") or not self.line:
            text = text.removeprefix(" ")
        if text:
            self.line.append(text)

    def end(self, space: bool = False) -> None:
        text = "".join(self.line).rstrip(" ")
        self.line = []
        if text:
            self.put(text)
        self.blank = self.blank or (space and bool(self.lines))

    def put(self, line: str) -> None:
        if self.blank and self.lines:
            self.lines.append("")
        self.blank = False
        self.lines.append(line)


def render(node: Node, out: Writer) -> None:
    """Write what is visible below ``node``.

    The walk keeps its own stack, so deep nesting does not end it. Each entry is a node to open, a text, or a step to
    take after a node's children.
    """
    todo: list = [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.words(item)
            continue
        if callable(item):
            item()
            continue
        if item.hidden():
            continue
        name = item.name
        if name == "br":
            text = bool(out.line)
            out.end()
            if not text:
                out.blank = bool(out.lines)
        elif name == "hr":
            out.end(True)
        elif name == "img":
            out.words(item.attributes.get("alt", ""))
        elif name == "table" and _is_grid(item):
            out.end(True)
            todo.append(lambda: out.end(True))
            for part in reversed(_table(item)):
                todo.append((lambda line=part: (out.end(), out.put(line))) if isinstance(part, str) else part)
        elif name in ("pre", "textarea"):
            out.end(True)
            for line in _plain(item).strip("\n").split("\n"):
                out.put(line.rstrip())
            out.blank = True
        elif name in ("ul", "ol", "menu", "dir"):
            out.end(name in SPACED)
            todo.append(lambda: out.end(True))
            turn = int(n) if name == "ol" and re.fullmatch(r"-?[0-9]{1,9}", n := item.attributes.get("start", "1")) else 1
            for child in reversed(_items(item, turn)):
                todo.append(child)
        elif name == "select":
            out.end()
            todo.append(out.end)
            todo.extend(reversed(_options(item)))
        elif name in APART:
            todo.extend(x for child in reversed(item.children) for x in (" ", child))
        elif name in BLOCK or name == "text":
            out.end(name in SPACED)
            todo.append(lambda spaced=name in SPACED: out.end(spaced))
            todo.extend(reversed(item.children))
        else:
            todo.extend(reversed(item.children))


def _options(node: Node) -> list:
    """What a select element shows: all of a list box, and of a drop-down menu the option that is marked as selected.

    Of several marked ones the last is shown, without any the first one that can be chosen.
    """
    size = node.attributes.get("size", "")
    if "multiple" in node.attributes or re.fullmatch(r"\s*\+?0*([2-9]|[1-9][0-9]+)\s*", size):
        return node.children
    todo, marked, free = [(c, False) for c in reversed(node.children)], [], []
    while todo:
        item, off = todo.pop()
        if isinstance(item, Node) and not item.hidden():
            off = off or "disabled" in item.attributes
            if item.name != "option":
                todo.extend((c, off) for c in reversed(item.children))
            elif "selected" in item.attributes:
                marked.append(item)
            elif not off:
                free.append(item)
    return marked[-1:] or free[:1]


def _items(node: Node, turn: int) -> list:
    """Children of a list with the mark of each item before it: a dash, or its number in an ordered list."""
    made: list = []
    for child in node.children:
        if isinstance(child, Node) and child.name == "li" and not child.hidden():
            mark = f"{turn}. " if node.name == "ol" else "- "
            turn += 1
            marked = Node("li", child.attributes)
            marked.children = [mark, *_without_leading_space(child.children)]
            made.append(marked)
        else:
            made.append(child)
    return made


def _without_leading_space(children: list) -> list:
    """A block that starts an item is written on the line of its mark."""
    if children and isinstance(children[0], str) and not children[0].strip():
        children = children[1:]
    if children and isinstance(children[0], Node) and children[0].name in ("p", "div"):
        return [*_without_leading_space(children[0].children), Node("br"), *children[1:]]
    return children


def _is_grid(table: Node) -> bool:
    """Whether a table has cells of its own, which stand in columns."""
    todo = list(table.children)
    while todo:
        item = todo.pop()
        if isinstance(item, Node) and item.name != "table":
            if item.name in ("td", "th"):
                return True
            todo.extend(item.children)
    return False


def _holds_table(node: Node) -> bool:
    todo = [node]
    while todo:
        item = todo.pop()
        if isinstance(item, Node) and not item.hidden():
            if item.name == "table":
                return True
            todo.extend(item.children)
    return False


def _plain(node: Node) -> str:
    todo, out = [node], []
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item)
        elif item.name == "br":
            out.append("\n")
        elif not item.hidden():
            todo.extend(reversed(item.children))
    return "".join(out)


class Grid:
    """The columns of a table's cells: a cell takes the first one that no cell above reaches into."""

    def __init__(self):
        self.row, self.reach = 0, []  # (first column, end, row that is free again) of cells over several rows, in order

    def group(self) -> None:
        """Cells do not reach beyond their group of rows."""
        self.reach = []

    def place(self, spans: list[tuple[int, int]]) -> list[int]:
        """Columns of the cells of the next row, given how many columns and rows they span, and the end of the last."""
        above, column, at, made, new = [r for r in self.reach if r[2] > self.row], 0, 0, [], []
        for wide, high in spans:
            while at < len(above) and above[at][0] <= column:
                column, at = max(column, above[at][1]), at + 1
            made.append(column)
            if high > 1:
                new.append((column, column + wide, self.row + high))
            column += wide
        self.reach = []
        for first, end, free in sorted(above + new):
            if self.reach and self.reach[-1][1:] == (first, free):
                first = self.reach.pop()[0]
            self.reach.append((first, end, free))
        self.row += 1
        return [*made, column]


def _span(cell: Node) -> tuple[int, int]:
    """How many columns and rows a cell spans; 0 rows are all of its group."""
    wide, high = (int(v) if re.fullmatch(r"[0-9]{1,6}", v := cell.attributes.get(a, "1").strip()) else 1 for a in ("colspan", "rowspan"))
    return min(max(wide, 1), MOST_COLUMNS), min(high, MOST_ROWS) or MOST_ROWS


@lru_cache(1 << 14)
def _columns_of(character: str) -> int:
    if unicodedata.category(character) in ("Mn", "Me", "Cf"):
        return 0
    return 2 if unicodedata.east_asian_width(character) in "WF" else 1


def width(text: str) -> int:
    """Columns that a text takes on a screen: wide East Asian characters two, combining marks none."""
    return len(text) if text.isascii() else sum(map(_columns_of, text))


def _text_of(node: Node) -> str:
    part = Writer()
    for child in node.children:
        if isinstance(child, str):
            part.words(child)
        else:
            render(child, part)
    part.end()
    return " ".join(line for line in part.lines if line)


def _table(table: Node) -> list[str | Node]:
    """The lines of a table, and in their place the cells and other elements that hold a table, to be written as blocks.

    Rows are lines of cells, padded to the width of their column and set apart by a bar; other text stays in place.
    """
    rows: list[list[tuple[int, str]] | str | Node] = []
    grid, todo = Grid(), list(reversed(table.children))

    def other(item: Node | str) -> None:
        if isinstance(item, str):
            if item.strip():
                rows.append(_SPACE.sub(" ", item).strip())
        elif _holds_table(item):
            rows.append(item)
        elif not item.hidden():
            part = Node("div")
            part.children = [item]
            if text := _text_of(part):
                rows.append(text)

    while todo:
        item = todo.pop()
        if item is grid:
            grid.group()
        elif isinstance(item, str):
            other(item)
        elif item.hidden():
            continue
        elif item.name in ("thead", "tbody", "tfoot"):
            grid.group()
            todo += [grid, *reversed(item.children)]
        elif item.name == "form":
            todo += reversed(item.children)
        elif item.name in ("tr", "td", "th"):
            cells: list[Node] = []
            for cell in item.children if item.name == "tr" else [item]:
                if not isinstance(cell, Node) or cell.name not in ("td", "th"):
                    other(cell)
                elif not cell.hidden():
                    cells.append(cell)
            columns = grid.place([_span(c) for c in cells])
            if any(map(_holds_table, cells)):
                rows.extend(cells)
            elif any(texts := [_text_of(c) for c in cells]):
                rows.append([*zip(columns, texts), (columns[-1], "")])
        else:
            other(item)
    return _aligned(rows)


def _aligned(rows: list) -> list[str | Node]:
    """Lines for rows of ``(column, text)``, each with the end of its last cell; columns in which no cell starts are left out."""
    grid = [row for row in rows if isinstance(row, list)]
    columns = sorted({c for row in grid for c, _ in row[:-1]})
    at = {c: i for i, c in enumerate(columns)}
    widths = [0] * len(columns)
    for row in grid:
        for c, text in row[:-1]:
            widths[at[c]] = max(widths[at[c]], width(text))
    upto = [0, *accumulate(w + 3 for w in widths)]
    blanks, words = sum(upto[bisect_left(columns, row[-1][0])] for row in grid), sum(len(text) for row in grid for _, text in row)
    padded = blanks <= max(LEAST_PADDING, PADDING * words)

    def line(row: list) -> str:
        if not padded:
            return " | ".join(text for _, text in row if text)
        cells = [""] * bisect_left(columns, row[-1][0])
        for c, text in row[:-1]:
            cells[at[c]] = text
        return " | ".join(text + " " * (widths[i] - width(text)) for i, text in enumerate(cells)).rstrip(" ")

    return [line(row) if isinstance(row, list) else row for row in rows]


def page_text(page: str) -> str:
    out, root = Writer(), parse(page)
    if _VISIBILITY.search(page):
        settle(root)
    render(root, out)
    out.end()
    return "\n".join(out.lines)


def rendered_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``text`` of each row of ``pages``: id and all its visible text in reading order.

    Blocks start on new lines, with a blank line around paragraphs, headings, lists and tables; list items have a dash
    or their number. Cells of a table, also such as span columns or rows, are padded to aligned columns by their width on a
    screen; rows whose cells hold a table are written cell by cell as blocks, and a table that would be mostly padding
    (`PADDING`) is written without it. Text of drawings, formulas, text areas and list boxes is kept, of a drop-down menu
    the option that it shows at first. Scripts, styles, comments and elements that are hidden by name, attribute or inline
    style are left out; a visible element below an invisible one stays.

    Null and empty pages give an empty text. Pages of any length and depth are rendered whole, in time that grows with
    their length. Repeated rows get equal results; an empty table gives no rows; further columns are ignored.
    """
    rows = pages.select(pages[id_col], F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("html"))
    return map_rows(rows, lambda: lambda row: (row[0], page_text(row[1])), rows.select(rows[0]).schema.add("text", "string"))
