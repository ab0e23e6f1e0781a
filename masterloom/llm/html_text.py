"""HTML extraction: a tree builder with implied tags, and a renderer of what is visible.

The builder opens and closes elements as browsers do: void elements, raw text, paragraphs
that a block closes, list items, table rows and cells without their end tags, stray end
tags.  The renderer leaves out what is not shown (head, scripts, ``hidden``, closed
details, ``display: none`` and ``visibility: hidden`` in style attributes and in simple
rules of style elements) and writes all other text: white space folded as in a browser,
blocks on lines of their own with blank lines for margins, ``pre`` as it is, list items
with their markers, nested and indented, and tables as aligned columns.

Both work on explicit stacks, and an end tag finds what it closes by the places of open
elements, so depth does not matter.  Columns are aligned to their widest cell; only where
blanks would come to more than ``PADDING`` times the page are the widest columns of a table
narrowed until they do not.  Lists and quotes indent up to ``MOST_INDENT`` characters, and
deeper ones stay there.  So the text is linear in the page.  A null page gives null and an empty one an empty text; markup that never ends is read to
the end.  Repeated rows give the same text; extra columns are kept.
"""

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from masterloom.llm.common import column

# Element names by how HTML treats them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
UNSEEN = frozenset(
    "area base datalist head iframe link meta noembed noframes noscript object param script source style template title track".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p plaintext pre search section "
    "summary table ul xmp".split()
)
SPACED = frozenset("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr listing menu ol p pre table ul xmp".split())
CLOSES_P = BLOCKS - frozenset("body dd dt html legend li optgroup option".split())
#: What a start tag closes if it is open, and the elements that such a search stops at.
IMPLIED_END = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist", "optgroup")),
    "optgroup": (("option", "optgroup"), ("select", "datalist")),
    "rt": (("rt", "rp"), ("ruby",)),
    "rp": (("rt", "rp"), ("ruby",)),
    "caption": (("caption",), ("table",)),
    "thead": (("thead", "tbody", "tfoot", "caption"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "caption"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "caption"), ("table",)),
    "tr": (("tr", "caption"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
}
#: An end tag or a closed paragraph does not reach beyond these.
SCOPE = frozenset("body button caption html marquee object table td template th".split())

SPACE = " \t\n\r\f"
_SPACES = re.compile(r"[ \t\n\r\f]+")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=]+|=[^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_TAIL = re.compile(r"[\s/]*>?")
_ABRUPT = re.compile(r"-?>")
_COMMENT_END = re.compile(r"--!?>")
_STYLE_TOKEN = re.compile(r"[{};]|\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'", re.S)
_STYLE_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_SCREEN = re.compile(r"@media\s*(?:(?:only\s+)?(?:screen|all))?", re.I)
_SELECTOR = re.compile(r"[.#][a-zA-Z_][\w-]*|[a-zA-Z][\w-]*(?:[.#][a-zA-Z_][\w-]*)?")
_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([\w-]+)\s*(!\s*important)?", re.I)
_HIDDEN_STYLE = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)\b\s*(!\s*important)?", re.I)
_RIGHT = re.compile(r"(?:^|;)\s*text-align\s*:\s*right\b", re.I)
_PRE_STYLE = re.compile(r"(?:^|;)\s*white-space\s*:\s*(?:pre|pre-wrap|break-spaces)\b", re.I)
#: Values of ``display`` that make a block, and those that make none.
BLOCK_DISPLAYS = frozenset("block flex flow-root grid list-item table".split())
INLINE_DISPLAYS = frozenset("contents inline inline-block inline-flex inline-grid inline-table".split())
#: Blanks that align a page's tables, as a multiple of its length.
PADDING = 16
#: Where the indent of lists and quotes stops to grow.
MOST_INDENT = 200
#: Fixed value: columns that a cell may span, by the HTML standard.
MOST_SPAN = 1000


class Element:
    """A node: tag, attributes, and children that are texts or elements."""

    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]) -> None:
        self.tag, self.attributes, self.children = tag, attributes, []


class Builder:
    """Builds the tree of one page; ``styles`` is the text of its style elements."""

    def __init__(self) -> None:
        self.root = Element("#page", {})
        self.open = [self.root]
        #: Places in ``open`` of each tag's elements, so that no search walks a deep page.
        self.places: defaultdict[str, list[int]] = defaultdict(list)
        self.styles: list[str] = []
        self.title = ""

    def parse(self, page: str) -> Element:
        at, end = 0, len(page)
        while at < end:
            tag = page.find("<", at)
            if tag < 0:
                tag = end
            if tag > at:
                self._text(page[at:tag])
            if tag == end:
                break
            at = self._markup(page, tag)
        return self.root

    def _markup(self, page: str, at: int) -> int:
        if page.startswith("<!--", at):
            if abrupt := _ABRUPT.match(page, at + 4):
                return abrupt.end()
            stop = _COMMENT_END.search(page, at + 4)
            return stop.end() if stop else len(page)
        if page.startswith(("<!", "<?"), at):
            stop = page.find(">", at)
            return len(page) if stop < 0 else stop + 1
        closing = page.startswith("</", at)
        name = _NAME.match(page, at + 1 + closing)
        if not name:
            if closing:
                stop = page.find(">", at)
                return len(page) if stop < 0 else stop + 1
            self._text("<")
            return at + 1
        tag, at, attributes = name[0].lower(), name.end(), {}
        while found := _ATTRIBUTE.match(page, at):
            value = next((v for v in found.groups()[1:] if v is not None), "")
            attributes.setdefault(found[1].lower(), html.unescape(value) if "&" in value else value)
            at = found.end()
        at = _TAIL.match(page, at).end()
        if closing:
            self._end(tag)
            return at
        self._start(tag, attributes)
        return self._raw(page, at, tag) if tag in RAW else at

    def _raw(self, page: str, at: int, tag: str) -> int:
        stop = re.compile(f"</{tag}(?=[\\s/>]|$)", re.I).search(page, at)
        text = page[at : stop.start() if stop else len(page)]
        if tag == "style":
            self.styles.append(text)
        elif tag in ("textarea", "title"):
            text = html.unescape(text)
            self.title = self.title or (text if tag == "title" else "")
        self.open[-1].children.append(text)
        self._pop()
        if not stop:
            return len(page)
        close = page.find(">", stop.end())
        return len(page) if close < 0 else close + 1

    def _text(self, text: str) -> None:
        text = html.unescape(text) if "&" in text else text
        if self.open[-1].tag in ("table", "tbody", "thead", "tfoot", "tr") and text.strip(SPACE):
            self._before_table(text)
        else:
            self.open[-1].children.append(text)

    def _before_table(self, text: str) -> None:
        """Text in a table but in no cell is shown before the table."""
        at = self._innermost(("table",))
        if not at:
            self.open[-1].children.append(text)
            return
        outer = self.open[at - 1].children
        outer.insert(len(outer) - 1, text)

    def _start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag in ("html", "body", "head") and self.places[tag]:
            return
        if tag == "body":
            self._close(("head",), ())
        elif tag not in UNSEEN and self.open[-1].tag == "head":
            self._close(("head",), ())
        if tag in CLOSES_P:
            self._close(("p",), SCOPE)
        if tag in IMPLIED_END:
            self._close(*IMPLIED_END[tag])
        if re.fullmatch("h[1-6]", tag) and re.fullmatch("h[1-6]", self.open[-1].tag):
            self._pop()
        if tag in ("td", "th") and self.open[-1].tag in ("table", "tbody", "thead", "tfoot"):
            self._push("tr", {})
        self._push(tag, attributes)
        if tag in VOID:
            self._pop()

    def _push(self, tag: str, attributes: dict[str, str]) -> None:
        element = Element(tag, attributes)
        self.open[-1].children.append(element)
        self.places[tag].append(len(self.open))
        self.open.append(element)

    def _pop(self) -> None:
        self.places[self.open.pop().tag].pop()

    def _innermost(self, tags) -> int:
        """The place of the innermost open one of ``tags``; 0 for none."""
        return max((self.places[tag][-1] for tag in tags if self.places[tag]), default=0)

    def _close(self, tags: tuple[str, ...], barriers) -> None:
        """Close the innermost open one of ``tags`` unless a barrier is open inside it."""
        at = self._innermost(tags)
        if at and at >= self._innermost(barriers):
            while len(self.open) > at:
                self._pop()

    def _end(self, tag: str) -> None:
        if tag in ("html", "body", "br") or tag in VOID:
            if tag == "br":
                self._start("br", {})
            return
        if tag == "p" and not self._in_scope("p"):
            self._push("p", {})
        own = tag in SCOPE or tag in ("tr", "tbody", "thead", "tfoot")
        self._close((tag,), ("table",) if own and tag != "table" else () if own else SCOPE)

    def _in_scope(self, tag: str) -> bool:
        at = self._innermost((tag,))
        return at > 0 and at >= self._innermost(SCOPE)


class Writer:
    """Lines of text: folds white space, keeps margins, prefixes lists and quotes."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] | None = None
        self.space = False
        self.gap = 0
        self.prefix: list[str] = [""]
        self.first: str | None = None

    def _begin(self) -> None:
        if self.lines and self.gap > 1:
            self.lines.append("")
        self.gap = 0
        self.line = [self.first if self.first is not None else self.prefix[-1]]
        self.first = None

    def text(self, text: str) -> None:
        folded = _SPACES.sub(" ", text)
        words = folded.strip(" ")
        if not words:
            self.space = self.space or bool(folded)
            return
        if self.line is None:
            self._begin()
        elif self.space or folded[0] == " ":
            self.line.append(" ")
        self.line.append(words)
        self.space = folded[-1] == " "

    def exact(self, text: str) -> None:
        for at, part in enumerate(text.replace("\r\n", "\n").split("\n")):
            if at:
                self.new_line()
            if part:
                if self.line is None:
                    self._begin()
                elif self.space:
                    self.line.append(" ")
                self.space = False
                self.line.append(part)

    def new_line(self) -> None:
        if self.line is None:
            self._begin()
        self._end_line()

    def _end_line(self) -> None:
        self.lines.append("".join(self.line).rstrip(SPACE))
        self.line, self.space = None, False

    def block(self, gap: int) -> None:
        if self.line is not None:
            self._end_line()
        self.space = False
        self.gap = max(self.gap, gap)

    def push(self, marker: str, again: str) -> None:
        base = self.first if self.first is not None else self.prefix[-1]
        self.first = base[:MOST_INDENT] + marker
        self.prefix.append((self.prefix[-1] + again)[:MOST_INDENT])

    def pop(self) -> None:
        self.prefix.pop()
        self.first = None

    def rows(self, lines: list[str]) -> None:
        for line in lines:
            if self.line is not None:
                self._end_line()
            self._begin()
            self.line.append(line)
        self.block(1)

    def result(self) -> list[str]:
        self.block(0)
        lines = self.lines
        while lines and not lines[-1].strip(SPACE):
            lines.pop()
        begin = next((i for i, line in enumerate(lines) if line.strip(SPACE)), len(lines))
        return lines[begin:]


class Renderer:
    """Writes the visible text of a tree; a table's cells have writers of their own."""

    def __init__(self, styles: list[str], length: int) -> None:
        self.room = PADDING * length
        self.unseen, self.invisible = _simple_rules(styles)
        self.writer = Writer()
        self.outer: list[Writer] = []
        self.tables: list[list[list[tuple[list[str], int, int, bool]]]] = []
        self.lists: list[tuple[str, int, int]] = []
        self.visible, self.exact = [True], [False]

    def render(self, root: Element) -> str:
        todo: list = [(root, iter(root.children))]
        while todo:
            element, rest = todo[-1]
            child = next(rest, None)
            if child is None:
                todo.pop()
                if todo:
                    self._leave(element)
            elif isinstance(child, str):
                closed = element.tag == "details" and "open" not in element.attributes
                if self.visible[-1] and not closed:
                    (self.writer.exact if self.exact[-1] else self.writer.text)(child)
            elif self._enter(child, element):
                todo.append((child, iter(child.children)))
        return "\n".join(self.writer.result())

    def _shown(self, element: Element, parent: Element) -> bool:
        attributes, tag = element.attributes, element.tag
        if tag in UNSEEN or "hidden" in attributes or tag in self.unseen:
            return False
        if not attributes and tag not in ("dialog",) and parent.tag != "details":
            return True
        if tag == "dialog" and "open" not in attributes or tag == "input" and attributes.get("type", "").lower() == "hidden":
            return False
        if parent.tag == "details" and tag != "summary" and "open" not in parent.attributes:
            return False
        if self.unseen and not self.unseen.isdisjoint(_names(element)):
            return "display:" in attributes.get("style", "").replace(" ", "") and not _HIDDEN_STYLE.search(attributes["style"])
        return not _HIDDEN_STYLE.search(attributes.get("style", ""))

    def _visibility(self, element: Element) -> bool:
        attributes = element.attributes
        if found := _VISIBILITY.search(attributes.get("style", "")):
            return found[1].lower() == "visible"
        if self.invisible:
            if not self.invisible.isdisjoint(_names(element)):
                return False
        return self.visible[-1]

    def _enter(self, element: Element, parent: Element) -> bool:
        if not self._shown(element, parent):
            return False
        tag, writer = element.tag, self.writer
        self.visible.append(self._visibility(element) if element.attributes or self.invisible else self.visible[-1])
        style = element.attributes.get("style", "")
        self.exact.append(self.exact[-1] or tag in ("pre", "listing", "xmp", "textarea") or bool(style and _PRE_STYLE.search(style)))
        if tag == "br":
            if self.visible[-1]:
                writer.new_line()
        elif tag == "input" and self.visible[-1] and element.attributes.get("type", "").lower() in ("submit", "button", "reset"):
            writer.text(element.attributes.get("value", ""))
        elif _is_block(element):
            nested = tag in ("ul", "ol", "menu", "dl") and self.lists
            writer.block(2 if tag in SPACED and not nested else 1)
        if tag in ("ul", "ol", "menu"):
            step = -1 if tag == "ol" and "reversed" in element.attributes else 1
            items = sum(isinstance(c, Element) and c.tag == "li" for c in element.children) if step < 0 else 1
            self.lists.append((tag, _number(element.attributes.get("start"), items), step))
        elif tag == "li":
            writer.push(marker := self._marker(element), " " * len(marker))
        elif tag == "blockquote":
            writer.push("> ", "> ")
        elif tag == "dd":
            writer.push("  ", "  ")
        elif tag == "q":
            writer.text("“") if self.visible[-1] else None
        elif tag == "table":
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag in ("td", "th", "caption") and self.tables:
            self.outer.append(writer)
            self.writer = Writer()
            self.lists.append(("", 0, 0))
        return True

    def _marker(self, element: Element) -> str:
        if not self.lists or self.lists[-1][0] != "ol":
            return "- "
        kind, number, step = self.lists[-1]
        number = _number(element.attributes.get("value"), number)
        self.lists[-1] = kind, number + step, step
        return f"{number}. "

    def _leave(self, element: Element) -> None:
        tag = element.tag
        if tag == "q" and self.visible[-1]:
            self.writer.space = False
            self.writer.text("”")
        self.visible.pop()
        self.exact.pop()
        if tag in ("td", "th", "caption") and self.tables:
            lines, self.writer = self.writer.result(), self.outer.pop()
            self.lists.pop()
            if tag == "caption":
                self.writer.rows(lines)
                return
            if not self.tables[-1]:
                self.tables[-1].append([])
            right = element.attributes.get("align", "").lower() == "right" or bool(_RIGHT.search(element.attributes.get("style", "")))
            across = min(max(_number(element.attributes.get("colspan"), 1), 1), MOST_SPAN)
            self.tables[-1][-1].append((lines, across, max(_number(element.attributes.get("rowspan"), 1), 1), right))
        elif tag == "table" and self.tables:
            lines, padded = table_lines(self.tables.pop(), self.room)
            self.room -= padded
            self.writer.rows(lines)
        elif tag in ("ul", "ol", "menu"):
            self.lists.pop()
        if _is_block(element):
            nested = tag in ("ul", "ol", "menu", "dl") and self.lists
            self.writer.block(2 if tag in SPACED and not nested else 1)
        if tag in ("li", "blockquote", "dd"):
            self.writer.pop()


def _names(element: Element) -> Iterator[str]:
    """What a simple selector, or a tag with one, calls the element."""
    tag, attributes = element.tag, element.attributes
    yield tag
    for name in [f".{c}" for c in attributes.get("class", "").split()] + ([f"#{attributes['id']}"] if "id" in attributes else []):
        yield name
        yield tag + name


def _is_block(element: Element) -> bool:
    """Whether it stands on lines of its own: by its style attribute, else by its tag."""
    if "style" in element.attributes:
        shown = [found[1].lower() for found in _DISPLAY.finditer(element.attributes["style"])]
        if shown and shown[-1] in BLOCK_DISPLAYS | INLINE_DISPLAYS:
            return shown[-1] in BLOCK_DISPLAYS
    return element.tag in BLOCKS


def _number(text: str | None, otherwise: int) -> int:
    return int(text) if text and re.fullmatch(r"-?[0-9]{1,9}", text.strip()) else otherwise


def _simple_rules(styles: list[str]) -> tuple[frozenset[str], frozenset[str]]:
    """Tags, ``.classes``, ``#ids`` and tags with one of these that the page's style elements do not show.

    Of rules on the same selector the last one counts, but after one that is important.
    """
    display: dict[str, tuple[bool, bool]] = {}
    visibility: dict[str, tuple[bool, bool]] = {}
    for selectors, body in (rule for text in styles for rule in _plain_rules(text)):
        names = {s for s in (s.strip() for s in selectors.split(",")) if _SELECTOR.fullmatch(s)}
        for of, pattern, shown in ((display, _DISPLAY, lambda v: v != "none"), (visibility, _VISIBILITY, lambda v: v == "visible")):
            for found in pattern.finditer(body) if names else ():
                important = bool(found[2])
                for name in names:
                    if important or not of.get(name, (True, False))[1]:
                        of[name] = shown(found[1].lower()), important
    return tuple(frozenset(n for n, (shown, _) in of.items() if not shown) for of in (display, visibility))


def _plain_rules(style: str) -> Iterator[tuple[str, str]]:
    """Selectors and declarations of the rules that hold on any screen.

    The bodies of at-rules are left out, but those of ``@media`` for screens or for all
    without a condition, and of ``@layer``.  A block within a rule is left out too.
    """
    style = _STYLE_COMMENT.sub(" ", style).replace("<!--", " ").replace("-->", " ")
    begin, depth, skipped, head, body = 0, 0, 0, None, ""  # depth: of open groups; skipped: of what is left out
    for token in _STYLE_TOKEN.finditer(style):
        mark = token[0]
        if mark not in "{};":
            continue
        text = style[begin : token.start()].strip()
        if skipped:
            skipped += (mark == "{") - (mark == "}")
        elif mark == "{":
            if head is not None:
                skipped, body = 1, body + text[: text.rfind(";") + 1]
            elif text.startswith("@"):
                media = text[:6].lower() == "@media" and any(_SCREEN.fullmatch(f"@media {q.strip()}".strip()) for q in text[6:].split(","))
                if media or text[:6].lower() == "@layer":
                    depth += 1
                else:
                    skipped = 1
            else:
                head, body = text, ""
        elif mark == "}":
            if head is not None:
                yield head, body + text
                head = None
            else:
                depth = max(depth - 1, 0)
        elif head is not None:
            continue  # the declarations of a rule are kept together
        begin = token.end()
    if head is not None and not skipped:
        yield head, body + style[begin:]


def table_lines(rows: list[list[tuple[list[str], int, int, bool]]], room: int) -> tuple[list[str], int]:
    """Aligned lines of a table whose cells are (lines, columns, rows, right-aligned), and their blanks.

    The columns are as wide as their widest cells, or narrowed alike until blanks take ``room`` at most.
    """
    grid, held = [], []  # held: columns that cells from above cover, as (first, behind the last, last row)
    for number, row in enumerate(rows):
        if not row:
            continue
        held = [span for span in held if span[2] >= number]
        placed, begun, at, after = [], [], 0, 0
        for lines, across, down, right in row:
            while after < len(held) and held[after][0] <= at:
                at, after = max(at, held[after][1]), after + 1
            placed.append((at, lines, across, right))
            if down > 1:
                if begun and begun[-1][1:] == (at, number + down - 1):
                    begun[-1] = begun[-1][0], at + across, number + down - 1
                else:
                    begun.append((at, at + across, number + down - 1))
            at += across
        held = sorted(held + begun)
        grid.append(placed)
    # A column where no cell begins takes no room.
    widths: dict[int, int] = {at: 0 for at in sorted({at for row in grid for at, *_ in row})}
    for at, lines, across, _ in (cell for row in grid for cell in row):
        if across == 1:
            widths[at] = max(widths[at], max(map(len, lines), default=0))
    heights = [max((len(lines) for _, lines, _, _ in row), default=0) for row in grid]

    def blanks(most: int) -> int:
        ends = _starts(widths, most)
        return sum(height * ends[row[-1][0]] for row, height in zip(grid, heights))

    most = max(widths.values(), default=0)
    if blanks(most) > room:
        low, high = -3, most  # at -3 no column takes room, so nothing is aligned
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if blanks(middle) <= room else (low, middle - 1)
        most = low
    starts, made = _starts(widths, most), []
    for row, height in zip(grid, heights):
        for number in range(height):
            text, length = [], 0
            for at, lines, across, right in row:
                part = lines[number] if number < len(lines) else ""
                if not part:
                    continue
                if at:
                    text.append(" " * (starts[at] - 3 - length) + " | ")
                    length += len(text[-1])
                text.append(part.rjust(min(widths[at], most)) if right and across == 1 else part)
                length += len(text[-1])
            made.append("".join(text))
    return made, blanks(most)


def _starts(widths: dict[int, int], most: int) -> dict[int, int]:
    """Where columns begin if none is wider than ``most``."""
    starts, place = {}, 0
    for at, width in widths.items():
        starts[at] = place
        place += min(width, most) + 3
    return starts


def page_text(page: str | None) -> str | None:
    """The visible text of one page."""
    if page is None:
        return None
    builder = Builder()
    tree = builder.parse(page)
    return Renderer(builder.styles, len(page)).render(tree)


def visible_text(page: Column) -> Column:
    """The visible text of a column of pages."""

    @arrow_udf("string")
    def render(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield pa.array([page_text(p.as_py()) for p in pages], pa.string())

    return render(page)


def extract_text(pages: DataFrame, html_col: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the visible text instead of the page; a column named like it is replaced."""
    kept = [column(c) for c in pages.columns if c != html_col and c.lower() != into.lower()]
    return pages.select(*kept, visible_text(column(html_col)).alias(into))
