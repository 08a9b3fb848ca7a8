"""Layout-aware text of HTML pages.

A tokenizer and a tree builder with implied start and end tags, then a walk that follows visibility rules (of elements,
attributes, inline styles and the page's own simple style rules) and lays blocks, lists, preformatted text and tables
out as plain text. Time and output are at most a fixed multiple of a page's length: the tree builder finds open elements
by name, indents end at MAX_INDENT columns, and tables align what is within the bounds below.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustloom.llm.common import arrow_type, map_arrow, rows_of

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
HIDDEN = frozenset("head title script style template noscript iframe noembed noframes audio video canvas datalist".split())
HIDDEN_IN_SVG = frozenset("title desc metadata defs symbol clippath mask pattern marker lineargradient radialgradient filter".split())
HIDDEN_IN_MATH = frozenset(("annotation", "annotation-xml"))
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre listing xmp table figure fieldset hr form".split())
BLOCK = SPACED | frozenset("html body address article aside center dd details dialog dir div dt figcaption footer header hgroup legend li main menu nav optgroup option search section summary tr caption".split())
CLOSES_P = (SPACED | frozenset("address article aside center details dialog dir div dd dt figcaption footer header hgroup li main menu nav search section summary".split())) - {"table"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Inline elements whose end tag leaves blocks open that began inside of them.
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
#: Elements that hold formatting in: what is opened inside ends with them.
MARKERS = frozenset("td th caption template object applet marquee".split())
#: Elements that an end tag of another inline element doesn't reach through.
SPECIAL = BLOCK | VOID | frozenset("applet button col colgroup frame frameset head marquee object plaintext script select style tbody td template textarea tfoot th thead title iframe noembed noframes noscript".split())
#: A start tag ends these open elements, up to (not through) the nearest of the barriers.
IMPLIED_END = {
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "tr": (("tr", "td", "th", "caption", "colgroup"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "thead": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "tbody": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "caption": (("caption",), ("table",)),
}
SECTIONS = frozenset(("thead", "tbody", "tfoot"))
PREFORMATTED = frozenset("pre listing xmp".split())
#: Start tags that end an open svg or math element, unless one of its HTML holders is open.
BREAKS_OUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
HOLDERS = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
#: Start tags that leave an open head open; any other begins the body.
IN_HEAD = frozenset("base link meta title style script noscript template".split())
_SCOPE = frozenset("html table td th caption button object template".split())

# A quote opens a value only after '='; elsewhere it is a character of a name or of an unquoted value.
_TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+>?|</[^a-zA-Z][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)?+)?+)*+)(>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"?|'([^']*+)'?|([^\s>"'][^\s>]*+))?+)?+""")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_DECLARED = re.compile(r"(?:^|;)\s*(display|visibility|white-space)\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_SELECTOR = re.compile(r"([a-z][\w-]*|\*)?(?:([.#])([\w-]+))?", re.I)
_INTEGER = re.compile(r"\s*(-?\d{1,8})\s*")

#: Columns that lines are indented by at most; columns of a table, and of a line, within which cells are aligned; the
#: width that a column keeps free at most; how deep tables stand in cells before theirs follow each other as blocks.
MAX_INDENT, TABLE_COLUMNS, MAX_LINE, MAX_COLUMN, TABLE_DEPTH = 32, 200, 400, 100, 8
_BLOCKS = frozenset("block flex grid flow-root list-item table".split())
_INLINE = frozenset("inline inline-block inline-flex inline-grid inline-table contents".split())
_KEEP, _COLLAPSE, _LINES = frozenset("pre pre-wrap break-spaces".split()), frozenset("normal nowrap".split()), "pre-line"


class Node:
    __slots__ = ("name", "attributes", "children")

    def __init__(self, name: str, attributes: str = ""):
        self.name, self.attributes, self.children = name, attributes, []

    def get(self, key: str) -> str | None:
        """An attribute's value, '' if it has none, None if it's absent."""
        if key in self.attributes.lower():
            for m in _ATTRIBUTE.finditer(self.attributes):
                if m[1].lower() == key:
                    return html.unescape(m[2] or m[3] or m[4] or "")
        return None


class Ended:
    """Where a formatting element ends. It needn't end where the element that holds its start does."""

    __slots__ = ("node",)

    def __init__(self, node: Node):
        self.node = node


class OpenElements(list):
    """The open elements, innermost last, with the places of each name, so that no search walks them.

    Formatting elements aren't among them: their starts and ends stand in the tree by themselves, so that a block that
    begins inside of one goes on after it. Those open in a cell or the like end with it.
    """

    def __init__(self, root: Node):
        super().__init__([root])
        self.at: defaultdict[str, list[int]] = defaultdict(list)
        self.special: list[int] = []  # of elements that inline end tags stop at
        self.firm: list[int] = []  # of those that a list item's start tag stops at
        self.scopes: list[tuple[int, defaultdict[str, list[Node]]]] = [(0, defaultdict(list))]

    def push(self, node: Node) -> None:
        place = len(self)
        self.append(node)
        self.at[node.name].append(place)
        if node.name in SPECIAL:
            self.special.append(place)
            if node.name not in ("address", "div", "p"):
                self.firm.append(place)
        if node.name in MARKERS:
            self.scopes.append((place, defaultdict(list)))

    def cut(self, start: int) -> None:
        """End the element at a place and all inside of it."""
        while len(self) > start:
            node = self.pop()
            self.at[node.name].pop()
            for places in (self.special, self.firm):
                if places and places[-1] == len(self):
                    places.pop()
            if self.scopes[-1][0] == len(self):
                for held in self.scopes.pop()[1].values():
                    node.children += [Ended(x) for x in held]

    def nearest(self, names: Iterable[str]) -> int:
        """The place of the innermost open element of these names, 0 if none is open."""
        return max((self.at[x][-1] for x in names if self.at[x]), default=0)

    def start_formatting(self, node: Node) -> None:
        if node.name in ("a", "nobr"):
            self.end_formatting(node.name)
        self.scopes[-1][1][node.name].append(node)
        self[-1].children.append(node)

    def end_formatting(self, name: str) -> None:
        held = self.scopes[-1][1][name]
        if held:
            self[-1].children.append(Ended(held.pop()))

    def foreign(self) -> bool:
        """Whether svg or math is open, and no foreignObject, whose content is HTML again."""
        return bool((self.at["svg"] or self.at["math"]) and not self.at["foreignobject"])


def parse(source: str) -> tuple[Node, list[str]]:
    """The tree of a page and its style sheets; text nodes are strings. Any input gives a tree."""
    root = Node("html")
    stack, at, n = OpenElements(root), 0, len(source)
    find, begun = _TOKEN.search, False  # begun: there was a head, or the body is open
    body, sheets = "", []  # attributes of body tags: of attributes that are repeated the first counts
    while at < n:
        m = find(source, at)
        if m is None:
            stack[-1].children.append(source[at:])
            break
        if m.start() > at:
            _text(stack, source[at : m.start()])
            begun = begun or not source[at : m.start()].isspace()
        at = m.end()
        name = m[2]
        if not name:
            continue
        name = name.lower()
        if m[1]:
            _end(stack, name)
            continue
        if name in ("html", "body"):
            if name == "html":
                root.attributes += " " + (m[3] or "")
            else:
                begun = True
                body += " " + (m[3] or "")
                _end(stack, "head")
            continue
        if name == "head" and begun:
            continue
        if name == "head" or name not in IN_HEAD and not stack.at["template"] and not stack.at["noscript"]:
            begun = True
            if stack.at["head"]:
                stack.cut(stack.at["head"][0])
        foreign = stack.foreign()
        if foreign and name in BREAKS_OUT and not any(stack.at[x] for x in HOLDERS):
            stack.cut(min(stack.at[x][0] for x in ("svg", "math") if stack.at[x]))
            foreign = False
        node = Node(name, (m[3] or "").strip())
        if not foreign:
            if name in FORMATTING:
                stack.start_formatting(node)
                continue
            _implied(stack, name)
        stack[-1].children.append(node)
        if name in VOID or (foreign or name in ("svg", "math")) and node.attributes.endswith("/"):
            continue
        if name in RAW and (not foreign or name in ("script", "style")):
            close = _RAW_END[name].search(source, at)
            end = close.start() if close else n
            if name in ("textarea", "title"):
                node.children.append(source[at:end].removeprefix("\r").removeprefix("\n") if name == "textarea" else source[at:end])
            elif name == "xmp":
                node.children.append(html.escape(source[at:end], quote=False))
            elif name == "style" and _screen(node.get("media") or ""):
                sheets.append(source[at:end])
            close = source.find(">", end)
            at = n if close < 0 else close + 1
        elif name == "plaintext":
            node.children.append(html.escape(source[at:], quote=False))
            break
        else:
            stack.push(node)
            if name in PREFORMATTED:  # a line break right after the tag isn't part of the text
                at += 2 if source.startswith("\r\n", at) else source.startswith("\n", at)
    if body.strip():
        inner = Node("body", body)
        inner.children, root.children = root.children, [inner]
    return root, sheets


def _text(stack: OpenElements, text: str) -> None:
    top = stack[-1]
    if top.name == "head" and not text.isspace():  # text isn't part of the head: the body begins
        _end(stack, "head")
        top = stack[-1]
    top.children.append(text)


def _implied(stack: OpenElements, name: str) -> None:
    """End what a start tag ends, and start what it needs."""
    if name in ("li", "dd", "dt") and stack.firm:
        place = stack.firm[-1]
        if stack[place].name in (("li",) if name == "li" else ("dd", "dt")):
            stack.cut(place)
    if name in CLOSES_P:
        if (p := stack.nearest(("p",))) > stack.nearest(_SCOPE):
            stack.cut(p)
        if name in HEADINGS and stack[-1].name in HEADINGS and len(stack) > 1:
            stack.cut(len(stack) - 1)
    if rule := IMPLIED_END.get(name):
        ends, barriers = rule
        after = stack.nearest((*barriers, "table"))
        first = [places[k] for x in ends if (places := stack.at[x]) and (k := bisect_right(places, after)) < len(places)]
        if first:
            stack.cut(min(first))
    if name in ("td", "th") and stack[-1].name in SECTIONS | {"table"}:
        _implied(stack, "tr")
        row = Node("tr")
        stack[-1].children.append(row)
        stack.push(row)
    elif name == "tr" and stack[-1].name == "table":
        body = Node("tbody")
        stack[-1].children.append(body)
        stack.push(body)


def _end(stack: OpenElements, name: str) -> None:
    """Close the nearest open element of that name; a cell or table keeps what is outside of it open, a block what is inline."""
    if name == "br":
        stack[-1].children.append(Node("br"))
        return
    if name in FORMATTING and not stack.at[name]:
        stack.end_formatting(name)
        return
    place = stack.nearest(HEADINGS if name in HEADINGS else (name,))
    if place:
        if name in ("table", "tr", "tbody", "thead", "tfoot"):
            held = stack.nearest(("table",)) if name != "table" else 0
        elif name in SPECIAL:
            held = stack.nearest(("table", "td", "th"))
        else:
            held = stack.special[-1] if stack.special else 0
        if held <= place:
            stack.cut(place)
            return
    if name == "p":
        stack[-1].children.append(Node("p"))


class Sink:
    """Lines of one box: pending spaces and blank lines appear only between things that are shown."""

    __slots__ = ("lines", "line", "space", "gap", "marked")

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line, self.space, self.gap, self.marked = [], False, 0, False

    def text(self, text: str, prefix: str) -> None:
        """Text with white space collapsed."""
        if not text:
            return
        words = _SPACES.sub(" ", text)
        if words[0] == " ":
            self.space = True
            words = words[1:]
        if words:
            trailing = words[-1] == " "
            words = words[:-1] if trailing else words
            self._start(prefix)
            self.line.append(" " + words if self.space and len(self.line) > 1 else words)
            self.space = trailing

    def _start(self, prefix: str) -> None:
        if not self.line:
            if self.gap and self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            self.line.append(prefix)

    def end_line(self) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []
        self.space = self.marked = False

    def block(self, spaced: bool) -> None:
        if self.marked and len(self.line) == 1:  # a list item's first block starts beside its mark
            return
        self.end_line()
        if spaced:
            self.gap = 1

    def put(self, lines: list[str], prefix: str) -> None:
        """Whole lines as they are."""
        for line in lines:
            self._start(prefix)
            self.line.append(line)
            self.lines.append("".join(self.line).rstrip())
            self.line = []

    def done(self) -> list[str]:
        self.end_line()
        return self.lines


def width(text: str) -> int:
    """Columns that a text takes: wide characters two, combining ones none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _screen(media: str) -> bool:
    """Whether a medium's rules hold on a screen of any size."""
    media = media.lower()
    return "(" not in media and (not media.strip() or "all" in media or "screen" in media)


def _declared(text: str) -> dict[str, tuple[bool, str]]:
    """Of the properties that are followed, the last value or the last that is important, and whether it is."""
    out: dict[str, tuple[bool, str]] = {}
    for m in _DECLARED.finditer(text):
        key = m[1].lower()
        if m[3] or key not in out or not out[key][0]:
            out[key] = (bool(m[3]), m[2].lower())
    return out


class Rules:
    """A page's own style rules whose selector is a tag, a class, an id, or a tag with one of those."""

    def __init__(self, sheets: list[str]):
        self.by: dict[tuple[str, str, str], dict[str, tuple]] = {}
        self.count = 0  # of rules so far: of equal ones the last holds
        for sheet in sheets:
            holds, at, selectors = [True], 0, []
            sheet = _COMMENT.sub("", sheet)
            for m in re.finditer("[{}]", sheet):
                before = sheet[at : m.start()]
                at = m.end()
                if m[0] == "{":
                    prelude = before.rpartition(";")[2].strip()
                    media = prelude[:6].lower() == "@media"
                    holds.append(holds[-1] and (media and _screen(prelude[6:]) or prelude[:1] != "@"))
                    selectors = [] if prelude[:1] == "@" else prelude.split(",")
                elif len(holds) > 1:
                    if holds.pop() and selectors and (found := _declared(before)):
                        self._add(selectors, found)
                    selectors = []

    def _add(self, selectors: list[str], found: dict[str, tuple[bool, str]]) -> None:
        for selector in selectors:
            m = _SELECTOR.fullmatch(selector.strip())
            if m and (m[1] or m[2]):
                tag = "" if m[1] in (None, "*") else m[1].lower()
                mine = self.by.setdefault((tag, m[2] or "", m[3] or ""), {})
                for key, (firm, value) in found.items():
                    self.count += 1
                    if key not in mine or firm >= mine[key][0][0]:
                        mine[key] = ((firm, {"#": 2, ".": 1, None: 0}[m[2]], bool(tag), self.count), value)

    def of(self, node: Node) -> dict[str, str]:
        """What holds for an element: its inline style, but for rules that are important where the style isn't."""
        inline = _declared(node.get("style") or "") if "style" in node.attributes.lower() else {}
        if not self.by:
            return {k: v for k, (_, v) in inline.items()}
        best: dict[str, tuple] = {k: ((firm, 3), v) for k, (firm, v) in inline.items()}
        keys = [("", "")]
        if node.attributes:
            keys += [(".", c) for c in (node.get("class") or "").split()]
            if name := node.get("id"):
                keys.append(("#", name))
        for kind, name in keys:
            for tag in ("", node.name):
                for key, ranked in self.by.get((tag, kind, name), {}).items():
                    if key not in best or ranked[0] > best[key][0]:
                        best[key] = ranked
        return {k: v for k, (_, v) in best.items()}


class _Table:
    """Cells by row; a cell that goes down several rows keeps its columns taken in those that there are."""

    def __init__(self) -> None:
        self.rows: list[list[tuple[int, int, list[str]]]] = []  # first column, columns, lines
        self.taken: list[list[int]] = []  # first column, column after, rows below that it still takes
        self.caption: list[str] = []
        self.next = self.at = 0  # the next free column; the taken places before it

    def row(self) -> None:
        self.rows.append([])
        self.next = self.at = 0
        for x in self.taken:
            x[2] -= 1
        self.taken = sorted(x for x in self.taken if x[2] >= 0)

    def section(self) -> None:
        """No cell goes down out of its section."""
        self.taken, self.at = [], 0

    def cell(self, lines: list[str], across: int, down: int) -> None:
        if not self.rows:
            self.row()
        while self.at < len(self.taken) and self.taken[self.at][0] <= self.next:
            self.next = max(self.next, self.taken[self.at][1])
            self.at += 1
        self.rows[-1].append((self.next, across, lines))
        self.next += across
        if down > 1 and len(self.taken) < TABLE_COLUMNS:
            self.taken.append([self.next - across, self.next, down - 1])  # what ends here is no hindrance to the row's next cells

    def layout(self) -> list[str]:
        cells = [x for row in self.rows for x in row]
        # Only columns where a cell begins or ends are told apart, and only the first ones are aligned.
        edges = sorted({c for c, across, _ in cells} | {c + across for c, across, _ in cells})[:TABLE_COLUMNS]
        place = {c: i for i, c in enumerate(edges)}
        widths = [0] * len(edges)
        for c, across, lines in sorted(cells, key=lambda x: x[1]):
            if c in place and c + across in place:
                first, last = place[c], place[c + across] - 1
                need = min(max(map(width, lines), default=0), MAX_COLUMN)
                have = sum(widths[first : last + 1]) + 2 * (last - first)
                if need > have:
                    widths[last] += need - have
        starts, x = [], 0
        for w in widths:
            starts.append(x)
            x = min(x + (w + 2 if w else 0), MAX_LINE)
        out = list(self.caption)
        for row in self.rows:
            left, k = [x for x in row if x[2]], 0
            while left:
                parts, used = [], 0
                for c, _, lines in left:
                    if lines[k]:
                        least = 2 if used else 0
                        pad = max(starts[place[c]] - used, least) if c in place else least
                        parts += (" " * pad, lines[k])
                        used += pad + width(lines[k])
                out.append("".join(parts))
                k += 1
                left = [x for x in left if len(x[2]) > k]
        return out


def _span(node: Node, key: str, most: int) -> int:
    value = (node.get(key) or "1").strip()
    return min(most, int(value)) if value.isascii() and value.isdigit() and len(value) < 6 else 1


def _integer(text: str | None) -> int | None:
    m = _INTEGER.fullmatch(text or "")
    return int(m[1]) if m else None


def _role(name: str, display: str) -> str:
    """What an element is laid out as."""
    if name in ("table", "tr", "caption") or name in SECTIONS:
        return name if name not in SECTIONS else "section"
    if name in ("td", "th"):
        return "cell"
    if display in _INLINE and name not in PREFORMATTED:
        return "inline"
    if name in ("ul", "ol", "menu", "dir"):
        return "list"
    if name in ("li", "dd", "blockquote"):
        return name
    return "spaced" if name in SPACED or name in PREFORMATTED else "block" if name in BLOCK or display in _BLOCKS else "inline"


class _Walk:
    """The state of a walk through a tree, and the lines so far."""

    def __init__(self, rules: Rules):
        self.rules = rules
        self.sinks, self.tables, self.lists = [Sink()], [], []
        self.indent, self.space = [""], ["normal"]  # white-space is inherited
        self.off = 0  # elements without a box that are open
        self.seen: list[list] = []  # declared visibilities of what is open, outermost first: [still open, hidden]
        self.formats: dict[int, tuple[bool, list | None]] = {}  # of open formatting elements: no box, visibility
        self.veiled: list[bool] = []  # blocks that began without a box and are open: whether they are spaced
        self.spaced = self.deep = 0  # how many of them are; aligned tables that are open
        self.inside = {"svg": 0, "math": 0}

    def unseen(self) -> bool:
        while self.seen and not self.seen[-1][0]:
            self.seen.pop()
        return bool(self.off or self.seen and self.seen[-1][1])

    def inner(self, more: str) -> None:
        self.indent.append((self.indent[-1] + more)[:MAX_INDENT])

    def style(self, node: Node) -> tuple[bool, list | None, dict[str, str]]:
        """Whether an element has no box, its visibility entry, all that is declared."""
        style = self.rules.of(node) if node.attributes or self.rules.by else {}
        none = style.get("display", "none" if node.attributes and node.get("hidden") is not None else "") == "none"
        seen = None
        if style.get("visibility") in ("hidden", "collapse", "visible"):
            seen = [True, style["visibility"] != "visible"]
            self.seen.append(seen)
        return none, seen, style

    def format(self, node: Node) -> None:
        none, seen, _ = self.style(node)
        self.off += none
        self.formats[id(node)] = (none, seen)

    def ended(self, node: Node) -> None:
        none, seen = self.formats.pop(id(node), (False, None))
        if seen:
            seen[0] = False
        if none:
            self.off -= 1
            if not self.off and self.veiled:  # a block that began inside goes on with a box of its own
                self.sinks[-1].block(self.spaced > 0)

    def text(self, text: str) -> None:
        if self.unseen():
            return
        sink, mode, indent = self.sinks[-1], self.space[-1], self.indent[-1]
        text = html.unescape(text) if "&" in text else text
        if mode == "normal":
            sink.text(text, indent)
            return
        for k, part in enumerate(text.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
            if k:
                if not sink.line:
                    sink._start(indent)
                sink.end_line()
            if part and mode == _LINES:
                sink.text(part, indent)
            elif part:
                sink._start(indent)
                sink.line.append(part)

    def enter(self, node: Node) -> tuple | None:
        """Lay out an element's start. What leave() needs, or None where nothing of it is shown."""
        name, sink = node.name, self.sinks[-1]
        if name in HIDDEN or self.inside["svg"] and name in HIDDEN_IN_SVG or self.inside["math"] and name in HIDDEN_IN_MATH:
            return None
        none, seen, style = self.style(node)
        none = none or name == "dialog" and node.get("open") is None
        if name in VOID:
            if not none and not self.off:
                self.void(node)
            if seen:
                seen[0] = False
            return None
        mode = style.get("white-space", "pre" if name in PREFORMATTED else "")
        mode = "pre" if mode in _KEEP else "normal" if mode in _COLLAPSE else mode if mode == _LINES else ""
        if mode:
            self.space.append(mode)
        self.off += none
        if name in self.inside:
            self.inside[name] += 1
        role = _role(name, style.get("display", ""))
        if self.off:
            if role != "inline":
                self.veiled.append(role in ("spaced", "list", "table", "blockquote"))
                self.spaced += self.veiled[-1]
            return node, "veiled" if role != "inline" else "inline", seen, mode, none
        if role == "table":
            sink.end_line()
            self.tables.append(_Table() if self.deep < TABLE_DEPTH else None)
            if self.tables[-1]:
                self.deep += 1
            else:
                sink.block(True)
        elif role in ("tr", "section", "cell", "caption"):
            if not self.tables or self.tables[-1] is None:
                role = "block"
                sink.block(False)
            elif role == "tr":
                self.tables[-1].row()
            elif role == "section":
                self.tables[-1].section()
            else:
                self.sinks.append(Sink())
                self.indent.append("")
        elif role == "list":
            sink.block(not self.lists)
            ordered, step = name == "ol", -1 if node.get("reversed") is not None else 1
            first = _integer(node.get("start"))
            if first is None:
                first = 1 if step > 0 else sum(isinstance(x, Node) and x.name == "li" for x in node.children)
            self.lists.append([ordered, first, step])
        elif role == "li":
            beside = sink.marked and len(sink.line) == 1  # a list at the start of an item begins beside its mark
            if not beside:
                sink.end_line()
            mark, of = "- ", self.lists[-1] if self.lists else None
            if of and of[0]:
                value = _integer(node.get("value"))
                of[1] = of[1] if value is None else value
                mark = f"{of[1]}. "
                of[1] += of[2]
            if not self.unseen():
                if beside:
                    sink.line[0] += mark
                else:
                    sink._start(self.indent[-1] + mark)
                sink.marked = True
            self.inner(" " * len(mark))
        elif role in ("dd", "blockquote"):
            sink.block(role == "blockquote")
            self.inner("  ")
        elif role in ("block", "spaced"):
            sink.block(role == "spaced")
        elif name == "text" and self.inside["svg"]:
            sink.space = True
        return node, role, seen, mode, none

    def void(self, node: Node) -> None:
        sink = self.sinks[-1]
        if node.name == "br":
            if not sink.line and sink.lines and not sink.gap:
                sink.lines.append("")
            sink.end_line()
        elif node.name == "hr":
            sink.block(True)
        elif node.name == "input" and not self.unseen() and (node.get("type") or "").lower() in ("submit", "button", "reset"):
            sink.text(node.get("value") or "", self.indent[-1])

    def leave(self, node: Node, role: str, seen: list | None, mode: str, none: bool) -> None:
        if seen:
            seen[0] = False
        if mode:
            self.space.pop()
        if node.name in self.inside:
            self.inside[node.name] -= 1
        sink = self.sinks[-1]
        if role == "veiled":
            spaced = self.veiled.pop()
            self.spaced -= spaced
            if not self.off:  # shown since a formatting element ended
                sink.block(spaced)
        self.off -= none
        if role in ("cell", "caption"):
            lines = self.sinks.pop().done()
            self.indent.pop()
            if role == "cell":
                self.tables[-1].cell(lines, max(1, _span(node, "colspan", 1000)), _span(node, "rowspan", 65534) or 65534)
            else:
                self.tables[-1].caption = lines
        elif role == "table":
            table = self.tables.pop()
            sink.block(True)
            if table:
                self.deep -= 1
                sink.put(table.layout(), self.indent[-1])
                sink.block(True)
        elif role == "list":
            self.lists.pop()
            sink.block(not self.lists)
        elif role in ("li", "dd", "blockquote"):
            if role == "li":
                sink.end_line()
            else:
                sink.block(role == "blockquote")
            self.indent.pop()
        elif role in ("block", "spaced"):
            sink.block(role == "spaced")
        elif role == "inline" and node.name == "text" and self.inside["svg"]:
            sink.space = True


def render(source: str) -> str:
    """The visible text of a page. Walks without recursion, so any depth will do."""
    root, sheets = parse(source)
    walk = _Walk(Rules(sheets))
    todo: list[Node | str | Ended | tuple] = [root]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            walk.text(x)
        elif isinstance(x, tuple):
            walk.leave(*x)
        elif isinstance(x, Ended):
            walk.ended(x.node)
        elif x.name in FORMATTING and not walk.inside["svg"] and not walk.inside["math"]:
            walk.format(x)
        elif entered := walk.enter(x):
            todo.append(entered)
            children = x.children
            if x.name == "details" and x.get("open") is None:
                children = [c for c in children if isinstance(c, Node) and c.name == "summary"][:1]
            todo += reversed(children)
    return "\n".join(walk.sinks[0].done())


def visible_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per input row: id, text, n_chars, n_lines.

    Null or empty HTML has empty text and no lines. Null and repeated ids of any type pass through, each row by itself.
    Long pages are rendered whole; time and text are at most a fixed multiple of their length, however deep they nest.
    Other columns are not read. An empty table gives no rows.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html"))
    id_name, id_type = dict(rows.dtypes)["id"], arrow_type(rows, "id")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sources in rows_of(batches, "id", "html"):
            texts = [render(s) for s in sources]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())],
                ["id", "text", "n_chars", "n_lines"],
            )

    return map_arrow(rows, run, f"id {id_name}, text string, n_chars long, n_lines long").withColumnRenamed("id", id_col)
