r"""HTML pages to the text that a reader sees, laid out as on the page.

A page is cut into tags and text, a tree is built with the end tags that
HTML lets authors leave out, hidden parts are passed over, and the rest is
laid out: white space collapses, blocks start on their own line and keep
their spacing, list items get bullets or numbers and indentation, table
cells are padded to aligned columns (rowspan and colspan included),
preformatted text keeps its line breaks (also blocks whose own style says
so), a line break after another leaves an empty line, and buttons show
their labels.

All visible text is emitted, navigation and footers too: this is a
renderer, not a main-content guesser.  Hidden are: head, scripts, styles,
templates, comments; elements with `hidden`, `display: none` or
`visibility: hidden` (which a child may undo), inline or by a style sheet
in the page with a plain tag, class or id selector (rules for print, for some
widths or under another condition do not count); closed dialogs and
details (but for their summary); hidden inputs.

Spark reads, partitions and writes; each page is rendered alone in an
Arrow batch of bounded bytes.  No shuffle.  Elements nested deeper than
``MAX_DEPTH`` become siblings there, as in browsers, so depth cannot exhaust
the stack and no text is lost.

Defined results: null html gives null text, empty html an empty one; an
unclosed tag or comment runs to the end of the page; repeated rows and an
empty table need no special care; other columns are untouched.
"""

from __future__ import annotations

import re
from itertools import accumulate
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import bounded_batches

MAX_DEPTH = 256
#: Widest span of a cell that is honoured, as in HTML.
MAX_SPAN = 1000

# Element names of HTML by their part in parsing and layout.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = set("script style textarea title xmp iframe noembed noframes".split())
NEVER_SEEN = set("head script style template title noscript iframe noembed noframes object datalist".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
               "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
BLOCK = CLOSES_P | set("html body li dt dd summary legend caption optgroup option tr td th".split())
TABLE_PARTS = set("table caption tbody thead tfoot tr td th".split())
#: Buttons made by an input element, and what they say without a value.
LABELLED = {"submit": "Submit", "reset": "Reset", "button": ""}
#: Values of white-space that keep spaces and line breaks as written.
PRESERVED = {"pre", "pre-wrap", "break-spaces"}
SPACED = set("blockquote dl figure fieldset h1 h2 h3 h4 h5 h6 hr ol p pre table ul".split())
#: start tag -> (tags it closes, tags beyond which it does not look)
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
}
IMPLIED_END["thead"] = IMPLIED_END["tfoot"] = IMPLIED_END["tbody"]
#: An end tag or an implied one does not reach out of these.
WALLS = {"table", "td", "th", "caption", "template"}

_TAG = re.compile(r"""<(?:!--(.*?)(?:-->|$)|[!?][^>]*(?:>|$)|/([a-zA-Z][^\s/>]*)[^>]*(?:>|$)"""
                  r"""|([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(?:>|$))""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_CSS_MARK = re.compile(r""""(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|[{};]""", re.S)
#: Media queries that hold on every screen.
ON_SCREEN = {"", "all", "screen", "only all", "only screen", "not print", "not speech"}
_SIMPLE = re.compile(r"[.#]?[\w-]+")
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("attributes", "children", "tag")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag = tag
        self.attributes = {}
        if attributes.strip(" /\n\t\r"):
            for name, a, b, c in _ATTRIBUTE.findall(attributes):
                self.attributes.setdefault(name.lower(), unescape(a or b or c))
        self.children: list[Node | str] = []


def parse(html: str) -> Node:
    """The page's tree; implied tags are closed, unknown end tags are ignored."""
    root = Node("html")
    stack, at, size = [root], 0, len(html)
    while at < size:
        m = _TAG.search(html, at)
        if m is None:
            _text(stack, html[at:])
            break
        if m.start() > at:
            _text(stack, html[at:m.start()])
        at = m.end()
        if m[2]:
            _end(stack, m[2].lower())
        elif m[3]:
            tag = m[3].lower()
            node = _start(stack, tag, m[4] or "")
            if tag in RAW_TEXT:
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                inner = html[at:close.start()] if close else html[at:]
                if inner:
                    node.children.append(unescape(inner) if tag in ("textarea", "title") else inner)
                at = close.end() if close else size
    return root


def _text(stack: list[Node], raw: str) -> None:
    stack[-1].children.append(unescape(raw) if "&" in raw else raw)


def _start(stack: list[Node], tag: str, attributes: str) -> Node:
    if tag in ("html", "body"):  # one of each: a second one only adds attributes
        node = stack[0] if tag == "html" else next((n for n in stack if n.tag == "body"), None)
        if node is not None:
            node.attributes = Node(tag, attributes).attributes | node.attributes
            return node
    if stack[-1].tag == "head" and tag not in ("meta", "link", "title", "style", "script", "base", "template", "noscript"):
        stack.pop()  # content ends the head
    if tag in IMPLIED_END:
        closes, wall = IMPLIED_END[tag]
        _close(stack, closes, wall | (WALLS - closes))
    elif tag in CLOSES_P:
        _close(stack, {"p"}, WALLS)
    if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
        _push(stack, Node("tr"))
    node = Node(tag, attributes)
    if tag in VOID or tag in RAW_TEXT:
        stack[-1].children.append(node)
    else:
        _push(stack, node)
    return node


def _push(stack: list[Node], node: Node) -> None:
    if len(stack) >= MAX_DEPTH:
        stack.pop()
    stack[-1].children.append(node)
    stack.append(node)


def _close(stack: list[Node], tags: set[str], walls: set[str]) -> None:
    """Close the outermost open element of ``tags`` that is not beyond a wall."""
    found = 0
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            found = i
        elif stack[i].tag in walls:
            break
    if found:
        del stack[found:]


def _end(stack: list[Node], tag: str) -> None:
    if tag == "br":
        stack[-1].children.append(Node("br"))
        return
    if tag in ("html", "body"):
        return
    table_part = tag in ("table", "tr", "td", "th", "tbody", "thead", "tfoot", "caption")
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return
        if stack[i].tag == "table" if table_part else stack[i].tag in WALLS:
            break
    if tag == "p":
        stack[-1].children.append(Node("p"))


# --- visibility ---------------------------------------------------------------------


def _declared(style: str) -> dict[str, str]:
    pairs = (d.split(":", 1) for d in style.lower().split(";") if ":" in d)
    return {k.strip(): v.replace("!important", "").strip() for k, v in pairs}


def _on_screen(media: str) -> bool:
    return any(_SPACE.sub(" ", query).strip() in ON_SCREEN for query in media.lower().split(","))


def _always(prelude: str) -> bool:
    """Whether the rules in an at-rule's block hold on every screen."""
    name, rest = re.match(r"@([\w-]*)(.*)", prelude, re.S).groups()
    return name.lower() == "layer" or name.lower() == "media" and _on_screen(rest)


def _css_rules(css: str):
    """(selectors, declarations) of the rules that hold on every screen; blocks are read by their braces."""
    blocks: list[tuple[str, bool, list[str]]] = []  # selectors, whether it holds, declarations
    start = 0
    for m in _CSS_MARK.finditer(css):
        if m[0] not in "{};":
            continue
        piece, start = css[start:m.start()].strip(), m.end()
        if m[0] == "{":
            outer, holds, _ = blocks[-1] if blocks else ("", True, [])
            if piece.startswith("@"):
                blocks.append((outer, holds and _always(piece), []))
            else:  # a rule in another rule is for descendants: no plain selector
                blocks.append((piece, holds and not outer, []))
        elif blocks:
            blocks[-1][2].append(piece)
            if m[0] == "}":
                selectors, holds, declarations = blocks.pop()
                if holds and selectors:
                    yield selectors, ";".join(declarations)


def _style_rules(root: Node) -> dict[str, dict[str, str]]:
    """Simple selector -> display, visibility and white-space, from the page's own style sheets."""
    rules: dict[str, dict[str, str]] = {}
    todo = [root]
    while todo:
        node = todo.pop()
        if node.tag == "style" and _on_screen(node.attributes.get("media", "")):
            css = re.sub(r"/\*.*?\*/", "", "".join(c for c in node.children if isinstance(c, str)), flags=re.S)
            for selectors, body in _css_rules(css):
                said = {k: v for k, v in _declared(body).items() if k in ("display", "visibility", "white-space")}
                for selector in selectors.split(",") if said else ():
                    if _SIMPLE.fullmatch(selector.strip()):
                        rules.setdefault(selector.strip(), {}).update(said)
        todo += [c for c in node.children if isinstance(c, Node)]
    return rules


def _styled(node: Node, rules: dict[str, dict[str, str]]) -> dict[str, str]:
    said: dict[str, str] = {}
    if rules:
        keys = [node.tag, *(f".{c}" for c in node.attributes.get("class", "").split()), f"#{node.attributes.get('id')}"]
        for key in keys:
            said |= rules.get(key, {})
    if "style" in node.attributes:
        said |= _declared(node.attributes["style"])
    return said


def _gone(node: Node, said: dict[str, str]) -> bool:
    return (node.tag in NEVER_SEEN or "hidden" in node.attributes or said.get("display") == "none"
            or (node.tag == "dialog" and "open" not in node.attributes)
            or (node.tag == "input" and node.attributes.get("type", "").lower() == "hidden"))


# --- layout -------------------------------------------------------------------------


class Flow:
    """Lines being written: inline text gathers until a block ends it."""

    def __init__(self):
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.gap = 0

    def text(self, raw: str) -> None:
        self.inline.append(raw)

    def end_line(self) -> None:
        """Put the gathered inline text, if it says anything, on a line of its own."""
        if self.inline:
            line = _SPACE.sub(" ", "".join(self.inline)).strip(" ")
            self.inline = []
            if line:
                self.put([line])

    def line_break(self) -> None:
        """End the line that is being written, or leave an empty one after what stands there."""
        if "".join(self.inline).strip(" \t\n\f\r"):
            self.end_line()
        else:
            self.inline = []
            self.gap += bool(self.lines)

    def put(self, lines: list[str]) -> None:
        if self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        self.lines += lines

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.gap = max(self.gap, int(spaced))


class Page:
    """Lays one tree out."""

    def __init__(self, root: Node):
        self.rules = _style_rules(root)
        self.root = root

    def render(self) -> str:
        return "\n".join(self.box(self.root, True))

    def box(self, node: Node, seen: bool) -> list[str]:
        flow = Flow()
        self.children(node, flow, seen)
        flow.end_line()
        return flow.lines

    def children(self, node: Node, flow: Flow, seen: bool) -> None:
        closed = node.tag == "details" and "open" not in node.attributes
        number, step = 0, 1
        if node.tag == "ol":
            step = -1 if "reversed" in node.attributes else 1
            least = sum(isinstance(c, Node) and c.tag == "li" for c in node.children) if step < 0 else 1
            number = _whole(node.attributes.get("start"), least)
        for child in node.children:
            if isinstance(child, str):
                if seen and not closed:
                    flow.text(child)
                continue
            if closed and child.tag != "summary":
                continue
            said = _styled(child, self.rules)
            if _gone(child, said):
                continue
            visibility = said.get("visibility")
            shown = seen if visibility is None else visibility not in ("hidden", "collapse")
            if child.tag == "li":
                number = _whole(child.attributes.get("value"), number) if node.tag == "ol" else 0
                self.item(child, flow, shown, f"{number}. " if node.tag == "ol" else "- ")
                number += step
            else:
                self.element(child, flow, shown, node, said)

    def element(self, node: Node, flow: Flow, seen: bool, parent: Node, said: dict[str, str]) -> None:
        tag = node.tag
        if tag == "br":
            flow.line_break()
        elif tag == "input":
            label = LABELLED.get(node.attributes.get("type", "").lower())
            if label is not None and seen:
                flow.text(node.attributes.get("value", label))
        elif tag in BLOCK and tag not in TABLE_PARTS and said.get("white-space") in PRESERVED:
            flow.block(tag in SPACED)
            lines = self.raw(node, seen).expandtabs(8).strip("\n").split("\n")
            if any(line.strip() for line in lines):
                flow.put([line.rstrip() for line in lines])
            flow.block(tag in SPACED)
        elif tag in ("pre", "textarea", "xmp"):
            flow.block(True)
            lines = self.raw(node, seen).expandtabs(8).strip("\n").split("\n")
            if any(line.strip() for line in lines):
                flow.put([line.rstrip() for line in lines])
            flow.block(True)
        elif tag == "table":
            flow.block(True)
            lines = self.table(node, seen)
            if lines:
                flow.put(lines)
            flow.block(True)
        elif tag in BLOCK:
            nested = tag in ("ul", "ol") and parent.tag == "li"
            spaced = tag in SPACED and not nested
            flow.block(spaced)
            if tag in ("blockquote", "dd"):
                lines = self.box(node, seen)
                if lines:
                    flow.put([("    " + line).rstrip() for line in lines])
            else:
                self.children(node, flow, seen)
            flow.block(spaced)
        elif tag not in VOID:
            self.children(node, flow, seen)

    def item(self, node: Node, flow: Flow, seen: bool, marker: str) -> None:
        flow.block(False)
        lines = self.box(node, seen)
        if lines:
            flow.put([marker + lines[0], *[(" " * len(marker) + line).rstrip() for line in lines[1:]]])

    def raw(self, node: Node, seen: bool) -> str:
        out = []
        for child in node.children:
            if isinstance(child, str):
                out.append(child if seen else "")
            elif child.tag == "br":
                out.append("\n")
            else:
                said = _styled(child, self.rules)
                if not _gone(child, said):
                    v = said.get("visibility")
                    out.append(self.raw(child, seen if v is None else v not in ("hidden", "collapse")))
        return "".join(out)

    def table(self, table: Node, seen: bool) -> list[str]:
        """Caption and what stands outside the rows first, then rows of padded cells."""
        above, grid, spans = Flow(), [], {}
        for row, shown in self.rows(table, seen, above):
            placed, column = [], 0
            for cell in row.children:
                if isinstance(cell, str) or cell.tag not in ("td", "th"):
                    continue
                said = _styled(cell, self.rules)
                if _gone(cell, said):
                    continue
                while spans.get(column, 0) > 0:  # taken by a cell of an earlier row
                    column += 1
                v = said.get("visibility")
                lines = self.box(cell, shown if v is None else v not in ("hidden", "collapse"))
                wide = min(MAX_SPAN, max(1, _whole(cell.attributes.get("colspan"), 1)))
                tall = max(1, _whole(cell.attributes.get("rowspan"), 1))
                placed.append((column, wide, lines))
                for c in range(column, column + wide):
                    spans[c] = tall
                column += wide
            spans = {c: left - 1 for c, left in spans.items() if left > 1}
            grid.append(placed)
        above.end_line()
        starts = self.starts(grid)
        out = list(above.lines)
        for placed in grid:
            for i in range(max((len(lines) for _, _, lines in placed), default=0)):
                line = ""
                for column, _, lines in placed:
                    if i < len(lines) and lines[i]:
                        line = (line.ljust(max(0, starts[column] - 3)) + " | " if column else line) + lines[i]
                if line:
                    out.append(line)
        return out

    @staticmethod
    def starts(grid) -> list[int]:
        """Where each column begins: after the widest cells before it.

        A cell over several columns widens the last of them by what it
        lacks; narrower spans come first.
        """
        widths = [0] * max((column + wide for placed in grid for column, wide, _ in placed), default=0)
        spanning = []
        for placed in grid:
            for column, wide, lines in placed:
                need = max(map(len, lines), default=0)
                if wide == 1:
                    widths[column] = max(widths[column], need)
                elif need:
                    spanning.append((wide, column, need))
        for wide, column, need in sorted(spanning):
            there = sum(widths[column:column + wide]) + 3 * (wide - 1)
            widths[column + wide - 1] += max(0, need - there)
        return [0, *accumulate(w + 3 for w in widths)]

    def rows(self, part: Node, seen: bool, above: Flow):
        """(row, visible) for the rows of a table; other content goes above."""
        for child in part.children:
            if isinstance(child, str):
                if seen and child.strip():
                    above.text(child)
                continue
            said = _styled(child, self.rules)
            if _gone(child, said):
                continue
            v = said.get("visibility")
            shown = seen if v is None else v not in ("hidden", "collapse")
            if child.tag == "tr":
                strays = [c for c in child.children if not (isinstance(c, str) or c.tag in ("td", "th"))]
                for stray in strays:
                    self.element(stray, above, shown, child, _styled(stray, self.rules))
                if any(isinstance(c, str) and c.strip() for c in child.children) and shown:
                    above.text(" ".join(c for c in child.children if isinstance(c, str)))
                yield child, shown
            elif child.tag in ("tbody", "thead", "tfoot"):
                yield from self.rows(child, shown, above)
            else:
                self.element(child, above, shown, part, said)


def _whole(value: str | None, default: int) -> int:
    m = re.match(r"\s*(-?\d{1,9})", value or "")
    return int(m[1]) if m else default


def render(html: str | None) -> str | None:
    """The visible text of a page, laid out; null for null."""
    return None if html is None else Page(parse(html)).render()


@F.pandas_udf(StringType())
def _rendered(pages: pd.Series) -> pd.Series:
    return pages.map(render, na_action="ignore")


def visible_text(html: Column) -> Column:
    """Column of laid-out visible text."""
    return _rendered(html)


def extract(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the visible text in column ``into`` (added, or replaced if it is there)."""
    bounded_batches(pages.sparkSession)
    return pages.withColumn(into, visible_text(F.col(html)))
