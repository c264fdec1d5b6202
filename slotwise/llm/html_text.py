"""HTML extraction: a tree with implied tags, rendered as a page would show it.

A tokenizer that knows comments, quoted attributes and raw-text elements feeds a tree builder that closes and opens tags
where HTML leaves them out. Rendering skips what is not shown, keeps blocks apart (paragraphs and headings by a blank
line), numbers and indents lists, keeps preformatted text, and lines up the cells of a table in columns. Text of drawings
(svg) and formulas (math) is text. All steps take time in proportion to the page, whatever its nesting and quotes.

Cases: a null page has a null text, an empty one an empty text. Broken markup is never an error: stray end tags are
ignored, open elements end with the page, a quoted value that does not end closes with the next `>`, and a tag without one is
text. Elements may nest to any depth; below LEVELS lists, quotes and tables within each other, more of them are plain
blocks, without indent or columns. Pages are read whole. Equal rows get equal results. An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Generator, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from slotwise.llm.common import with_made

#: Nested lists, quotes and tables that are laid out.
LEVELS = 40
# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = frozenset(
    "head script style template title noscript iframe object canvas audio video datalist noembed noframes "
    "desc defs metadata symbol clippath mask pattern annotation annotation-xml".split()
)
IN_HEAD = frozenset("base link meta title script style noscript template".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr fieldset menu dir xmp".split())
BLOCK = SPACED | frozenset(
    "html body address article aside center dd details dialog div dt fieldset figcaption footer form header hgroup legend li main nav "
    "optgroup option search section summary caption thead tbody tfoot tr td th svg text".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr li main menu nav ol p pre section summary table ul dt dd xmp".split()
)
#: A start tag ends open elements of these names, unless one of the limits is nearer.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}), "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}), "h1": ({"h1"}, set()), "body": ({"head"}, set()),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An end tag does not reach over these.
SCOPE = frozenset("table td th caption html template".split())
NAME = re.compile(r"(/?)([A-Za-z][^\s/>]*)")
#: What matters in a tag after its name: its end, or a value in quotes.
STEP = re.compile(r""">|=\s*(["'])""")
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
GAP = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: str):
        self.tag, self.attrs, self.kids = tag, attrs, []

    def attributes(self) -> dict[str, str]:
        found: dict[str, str] = {}
        for name, value in ATTRIBUTE.findall(self.attrs):
            found.setdefault(name.lower(), unescape(value.strip("\"'") if value[:1] in "\"'" else value))
        return found


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes) of a page; kind is text, start, end or raw (the text of a raw-text element)."""
    at, text, last, lost = 0, 0, page.rfind(">"), set()

    def end_of(at: int) -> int:
        """Place of the `>` that ends a tag, from a place with one ahead of it."""
        first = at
        while (m := STEP.search(page, at)) and m[1]:
            close = -1 if m[1] in lost else page.find(m[1], m.end())
            if close < 0:  # no such quote ahead of here, nor of any later place
                lost.add(m[1])
                return page.find(">", m.end()) if m.end() <= last else page.find(">", first)
            at = close + 1
        return m.start() if m else page.find(">", first)

    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            close = re.compile("--!?>").search(page, at + 4)
            stop = close.end() if close else len(page)
        elif page[at + 1 : at + 2] in ("!", "?"):
            stop = page.find(">", at) + 1 or len(page)
        elif (m := NAME.match(page, at + 1)) and m.end() <= last:
            stop = end_of(m.end()) + 1
        else:
            at += 1
            continue
        if at > text:
            yield "text", page[text:at], ""
        if page[at + 1] not in "!?":
            name, attrs = m[2].lower(), page[m.end() : stop - 1]
            yield ("end" if m[1] else "start"), name, attrs
            if not m[1] and name in RAW and not attrs.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, stop)
                close = end.start() if end else len(page)
                yield "raw", page[stop:close], name
                stop = end.end() if end else len(page)
        at = text = stop
    if text < len(page):
        yield "text", page[text:], ""


class Stack:
    """Open elements, and where those of each name are."""

    def __init__(self, root: Node):
        self.nodes, self.where = [root], {root.tag: [0]}

    def push(self, node: Node) -> None:
        self.where.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, size: int) -> None:
        while len(self.nodes) > size:
            self.where[self.nodes.pop().tag].pop()

    def last(self, names) -> int:
        """Place of the innermost open element of these names; 0 if none is open but the root."""
        return max((places[-1] for n in names if (places := self.where.get(n))), default=0)

    def close(self, names, limits) -> bool:
        """End the innermost of these names, unless a limit is nearer."""
        found = self.last(names)
        if found and found >= self.last(limits):
            self.cut(found)
            return True
        return False


def tree(page: str) -> Node:
    root = Node("html", "")
    body = None
    stack = Stack(root)
    nodes = stack.nodes

    def push(tag: str, attrs: str = "") -> None:
        node = Node(tag, attrs)
        nodes[-1].kids.append(node)
        if tag not in VOID:
            stack.push(node)

    def in_body() -> None:
        nonlocal body
        if stack.where.get("template"):
            return
        if len(nodes) > 1 and nodes[1].tag == "head":
            stack.cut(1)
        if body is None:
            push("body")
            body = nodes[-1]
        elif len(nodes) == 1:
            stack.push(body)

    def start(tag: str, attrs: str) -> None:
        nonlocal body
        if tag == "html":
            root.attrs += " " + attrs
            return
        if tag == "head":
            if body is None and len(nodes) == 1:
                push("head")
            return
        if tag == "body":
            in_body()
            body.attrs += " " + attrs
            return
        if not (body is None and tag in IN_HEAD):
            in_body()
        if tag in CLOSES_P:
            stack.close({"p"}, SCOPE | {"button"})
        if tag in HEADINGS and nodes[-1].tag in HEADINGS:
            stack.cut(len(nodes) - 1)
        elif tag in ENDS:
            names, limits = ENDS[tag]
            while stack.close(names, limits):
                pass
        if tag in ("td", "th") and nodes[-1].tag in ("table", "tbody", "thead", "tfoot"):
            push("tr")
        push(tag, attrs)

    for kind, name, rest in tokens(page):
        if kind == "text":
            if body is not None or not name.isspace():
                in_body()
                nodes[-1].kids.append(unescape(name) if "&" in name else name)
        elif kind == "start":
            start(name, rest)
        elif kind == "raw":
            if rest in ("textarea", "xmp"):
                nodes[-1].kids.append(unescape(name) if rest == "textarea" else name)
            stack.close({rest}, ())
        elif name == "br":
            start("br", "")
        elif name == "p" and not stack.where.get("p"):
            start("p", "")
            stack.cut(len(nodes) - 1)
        elif name not in ("html", "body"):
            stack.close({name}, () if name in SCOPE else SCOPE)
    return root


def shown(node: Node, seen: bool) -> bool | None:
    """Whether the element's own text shows, within an element whose text does or doesn't; None if no child shows either."""
    if node.tag in HIDDEN:
        return None
    if not node.attrs:
        return None if node.tag == "dialog" else seen
    a = node.attributes()
    style = re.sub(r"\s+|!important", "", a.get("style", "").lower())
    rules = dict(r.split(":", 1) for r in style.split(";") if ":" in r)
    if "hidden" in a or rules.get("display") == "none" or rules.get("content-visibility") == "hidden" or node.tag == "dialog" and "open" not in a:
        return None
    visibility = rules.get("visibility")
    return True if visibility == "visible" else False if visibility in ("hidden", "collapse") else seen


class Page:
    """Lines so far, the open line, and the empty lines that are due before the next text."""

    def __init__(self):
        self.lines, self.open, self.due, self.lead, self.blank = [], "", 0, "", False

    def end(self, due: int = 0) -> None:
        if self.open.strip():
            self.lines.append(self.open.rstrip())
        self.open, self.blank = "", False
        if self.lines:
            self.due = max(self.due, due)

    def put(self, text: str, pre: bool) -> None:
        if pre:
            first, *rest = text.split("\n")
            self.add(first, True)
            for line in rest:
                self.lines.append(self.open.rstrip())
                self.open = ""
                self.add(line, True)
            return
        words = GAP.sub(" ", text)
        if words[0] == " ":
            self.blank = True
            words = words[1:]
        if words:
            tail = words.endswith(" ")
            self.add((" " if self.blank and self.open else "") + words.rstrip(" "), False)
            self.blank = tail

    def add(self, text: str, pre: bool) -> None:
        if not text:
            return
        if not self.open:
            self.lines += [""] * self.due
            self.due = 0
            self.open = self.lead
            self.lead = ""
        self.open += text

    def nested(self, lines: list[str]) -> None:
        self.end()
        if lines:
            self.lines += [""] * self.due + lines
            self.due = 0


def finished(task: Generator):
    """Result of a task that yields the tasks it needs and gets their results: recursion without depth."""
    tasks, value = [task], None
    while tasks:
        try:
            tasks.append(tasks[-1].send(value))
            value = None
        except StopIteration as done:
            tasks.pop()
            value = done.value
    return value


def render(node: Node, page: Page, pre: bool, seen: bool, level: int) -> Generator:
    """Put an element's children into the page."""
    number = 0
    attrs = node.attributes() if node.tag == "ol" and node.attrs else {}
    if node.tag == "ol":
        start = attrs.get("start", "1")
        number = int(start) - 1 if re.fullmatch(r"-?\d{1,9}", start) else 0
    closed = node.tag == "details" and "open" not in node.attributes()
    deep = level >= LEVELS
    for kid in node.kids:
        if isinstance(kid, str):
            if seen and kid and not closed:
                page.put(kid, pre)
            continue
        own = shown(kid, seen)
        tag = kid.tag
        if own is None or closed and tag != "summary":
            continue
        if tag == "br":
            if page.open:
                page.end()
            elif page.lines and own:
                page.due = max(page.due, 1)
        elif tag == "hr":
            page.end(1)
        elif tag == "table" and not deep:
            page.end(1)
            page.nested((yield table_lines(kid, own, level + 1)))
            page.end(1)
        elif tag == "li":
            number += 1
            if "value" in kid.attrs and re.fullmatch(r"-?\d{1,9}", value := kid.attributes().get("value", "")):
                number = int(value)
            mark = f"{number}. " if node.tag == "ol" else "- "
            if deep:
                page.end()
                page.lead = mark
                yield render(kid, page, pre, own, level)
                page.end()
                page.lead = ""
            else:
                inner = yield block_lines(kid, pre, own, level + 1)
                page.nested([(mark if k == 0 else " " * len(mark) if line else "") + line for k, line in enumerate(inner)])
        elif tag in ("blockquote", "dd") and not deep:
            page.end(1 if tag in SPACED else 0)
            inner = yield block_lines(kid, pre, own, level + 1)
            page.nested(["  " + line if line else "" for line in inner])
            page.end(1 if tag in SPACED else 0)
        elif tag in BLOCK:
            gap = 0 if tag in ("ul", "ol") and node.tag == "li" else int(tag in SPACED)
            page.end(gap)
            yield render(kid, page, pre or tag in ("pre", "xmp", "textarea"), own, level)
            page.end(gap)
        else:
            yield render(kid, page, pre or tag == "textarea", own, level)


def block_lines(node: Node, pre: bool = False, seen: bool = True, level: int = 0) -> Generator:
    page = Page()
    yield render(node, page, pre, seen, level)
    page.end()
    return page.lines


class Grid:
    """Cells of a table by row and column; a cell may reach over columns, and into rows below of its group."""

    def __init__(self):
        self.rows: list[dict[int, list[str]]] = []
        self.held: list[tuple[int, int, int]] = []  # columns that cells above hold: (first, end, rows left)

    def group(self) -> None:
        self.held = []

    def row(self, cells: list[tuple[list[str], int, int]]) -> None:
        """A row of (lines, columns, rows) cells."""
        row, at, held = {}, 0, iter(sorted(self.held))
        taken = next(held, None)
        kept = [(a, b, n - 1) for a, b, n in self.held if n > 1]
        for lines, wide, high in cells:
            while taken and at >= taken[0]:
                at = max(at, taken[1])
                taken = next(held, None)
            row[at] = lines
            if high > 1:
                kept.append((at, at + wide, high - 1))
            at += wide
        self.rows.append(row)
        self.held = kept

    def lines(self) -> list[str]:
        """Rows as lines, columns in which a cell starts side by side."""
        width: dict[int, int] = {}
        for row in self.rows:
            for column, cell in row.items():
                width[column] = max(width.get(column, 0), max(map(len, cell), default=0))
        columns = sorted(width)
        out = []
        for row in self.rows:
            last = max(row, default=-1)
            used = [c for c in columns if c <= last]
            for k in range(max((len(cell) for cell in row.values()), default=0)):
                out.append("  ".join((cell[k] if k < len(cell := row.get(c, [])) else "").ljust(width[c]) for c in used).rstrip())
        return out


def span_of(node: Node, name: str) -> int:
    """colspan or rowspan; a rowspan of 0 reaches to the end of the group."""
    value = node.attributes().get(name, "1") if node.attrs else "1"
    if not re.fullmatch(r"[0-9]{1,6}", value):
        return 1
    return min(int(value), 1000) or 1 if name == "colspan" else min(int(value), 65534) or 65534


def table_lines(node: Node, seen: bool, level: int) -> Generator:
    """Rows of a table, cells side by side in columns of equal width; captions and other content stand above."""
    above, grid = [], Grid()

    def collect(part: Node, seen: bool) -> Generator:
        loose = Node("div", "")
        grid.group()
        for kid in part.kids:
            if isinstance(kid, str) or kid.tag not in ("thead", "tbody", "tfoot", "tr", "colgroup", "col"):
                loose.kids.append(kid)
            elif (own := shown(kid, seen)) is not None:
                if kid.tag == "tr":
                    grid.row((yield row_cells(kid, own)))
                else:
                    yield collect(kid, own)
                    grid.group()
        above.extend((yield block_lines(loose, False, seen, level)))

    def row_cells(row: Node, seen: bool) -> Generator:
        cells = []
        loose = Node("div", "")
        for kid in row.kids:
            if isinstance(kid, str) or kid.tag not in ("td", "th"):
                loose.kids.append(kid)
            elif (own := shown(kid, seen)) is not None:
                cells.append(((yield block_lines(kid, False, own, level)), span_of(kid, "colspan"), span_of(kid, "rowspan")))
        above.extend((yield block_lines(loose, False, seen, level)))
        return cells

    yield collect(node, seen)
    return above + grid.lines()


def page_text(html: str | None) -> str | None:
    if html is None:
        return None
    return "\n".join(finished(block_lines(tree(html))))


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, text, n_lines of each page."""
    made = pa.schema([("text", pa.string()), ("n_lines", pa.int64())])

    def worker():
        def of(html):
            text = page_text(html)
            return text, 0 if text is None else len(text.split("\n")) if text else 0

        return of

    return with_made(pages.select("page_id", "html"), "html", made, worker).drop("html")
