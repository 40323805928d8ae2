"""HTML extraction by layout-aware rendering.

A page's markup is cut into tags and text, a tree builder applies the rules of
implied tags (a ``p`` ends at the next block, ``li``, ``tr``, ``td``, ``option``
... end at their next sibling, the head ends at the first tag or text that
cannot stand in it, end tags close what is open inside), and the renderer walks
the tree:

* invisible parts - scripts, styles, templates, the head, titles, data lists,
  elements with a ``hidden`` attribute or a style of ``display:none`` or
  ``visibility:hidden`` (but for what is visible again inside) - give nothing;
* what stands in for content that a browser shows - in ``noscript``,
  ``iframe``, ``noembed``, ``noframes``, ``canvas``, ``audio``, ``video`` -
  gives nothing; inside ``object`` it is kept, as no object is loaded;
* options stand on lines of their own, chosen or not; MathML gives its tokens
  with blanks between, without annotations; SVG gives its ``text`` and
  ``foreignObject`` parts, without definitions, titles and descriptions;
* blocks stand on lines of their own, paragraphs and headings between blank
  lines; white space is collapsed outside ``pre``;
* list items get a bullet or a number and the indent of their depth;
* table cells are aligned in columns, a cell's line ends becoming spaces.

All other text is kept, navigation, footers and ``aria-hidden`` parts too.
Style sheets are not applied, and attributes (``alt``, ``value``,
``placeholder``, ``label``) give no text.  The tree is walked with
a stack of its own, so nesting may be of any depth.  Pages are a map over
Arrow batches; nothing is shuffled.

Defined results: null and empty pages give ''; broken markup gives the text
that a reader would see; rows that repeat are rendered each; an empty table
gives no rows; extra columns are ignored, whatever they are called.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import escape, unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructType

from pulsegraph.llm.common import fresh

# fixed values of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INVISIBLE = frozenset("head script style template noscript title iframe noembed noframes datalist canvas audio "
                      "video".split())
#: these give nothing inside svg or math
UNDRAWN = frozenset("defs symbol clippath mask marker pattern metadata title desc lineargradient radialgradient filter "
                    "script style annotation annotation-xml".split())
#: HTML stands in these parts of svg and math again
HTML_POINTS = frozenset("foreignobject desc title mi mo mn ms mtext".split())
MATH_TOKENS = frozenset("mi mo mn ms mtext".split())
#: start tags that end an open svg or math
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li "
                     "listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre "
                   "search section summary table tbody td tfoot th thead tr caption ul optgroup option".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure".split())
CLOSES_P = BLOCKS - frozenset("body html li dd dt td th tr tbody thead tfoot caption legend summary optgroup option".split())
#: start tags that do not end an open head
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: an opening tag ends these, unless a scope boundary is in between
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"),
    "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("td", "th", "tr", "tbody", "thead", "tfoot", "caption"),
    "thead": ("td", "th", "tr", "tbody", "thead", "tfoot", "caption"),
    "tfoot": ("td", "th", "tr", "tbody", "thead", "tfoot", "caption"),
}
BOUNDARY = {"li": frozenset(("ul", "ol", "menu", "table", "td", "th")), "dt": frozenset(("dl", "table", "td", "th")),
            "dd": frozenset(("dl", "table", "td", "th"))}
TABLE_BOUNDARY = frozenset(("table", "html"))
TABLE_PARTS = frozenset("table thead tbody tfoot tr td th caption".split())
SCOPE = frozenset("table td th caption html template object".split())

_TOKEN = re.compile(
    r"<!--(?:.*?)(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?:>|$)", re.S)
_ATTR = re.compile(r"([^\s/>][^\s/=>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_START = re.compile(r"\s*(-?\d{1,9})")
_HIDING = re.compile(r"(?i)hidden|style")
_COMMENT = re.compile(r"/\*.*?(?:\*/|$)", re.S)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children", "foreign")

    def __init__(self, tag: str, attrs: str = "", foreign: bool = False):
        self.tag, self.attrs, self.children, self.foreign = tag, attrs, [], foreign  # foreign: svg, math and what is in them


def attributes(raw: str) -> dict[str, str]:
    """Names in small letters to values; of equal names the first counts."""
    out: dict[str, str] = {}
    for m in _ATTR.finditer(raw):
        out.setdefault(m.group(1).lower(), unescape(m.group(2) or m.group(3) or m.group(4) or ""))
    return out


def _style(style: str) -> dict[str, str]:
    """Properties to values; the last counts, an important one above others."""
    out: dict[str, tuple[bool, str]] = {}
    for part in _COMMENT.sub(" ", style).lower().split(";"):
        name, _, value = part.partition(":")
        words = value.replace("!", " !").replace("! ", "!").split()
        important = "!important" in words
        if name.strip() not in out or important or not out[name.strip()][0]:
            out[name.strip()] = important, " ".join(w for w in words if w != "!important")
    return {name: value for name, (_, value) in out.items()}


def shown(raw: str, visible: bool) -> bool | None:
    """Whether an element with these attributes in a ``visible`` parent is; None if nothing in it is displayed."""
    if not _HIDING.search(raw):
        return visible
    given = attributes(raw)
    style = _style(given["style"]) if "style" in given else {}
    display = style.get("display", "")
    if display == "none" or ("hidden" in given and not display):
        return None
    visibility = style.get("visibility", "")
    return visible if visibility not in ("hidden", "collapse", "visible") else visibility == "visible"


def _visible(child: Node | str) -> bool:
    return bool(unescape(child).strip(" \t\n\r\f")) if isinstance(child, str) else child.tag not in IN_HEAD


def build_tree(html: str) -> Node:
    root = Node("html")
    stack = [root]
    open_p = 0  # p elements on the stack
    head = False  # there was one

    def pop_to(size: int) -> None:
        nonlocal open_p
        open_p -= sum(n.tag == "p" for n in stack[size:])
        del stack[size:]

    def add_text(text: str) -> None:
        if stack[-1].tag == "head" and unescape(text).strip(" \t\n\r\f"):
            pop_to(len(stack) - 1)
        stack[-1].children.append(text)

    def find(tags: tuple[str, ...], boundary: frozenset[str]) -> int:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return i
            if stack[i].tag in boundary:
                return 0
        return 0

    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        if not m:
            add_text(html[at:])
            break
        if m.start() > at:
            add_text(html[at:m.start()])
        at = m.end()
        if not m.group(2):
            if m.group().startswith("<![CDATA[") and stack[-1].foreign:
                stack[-1].children.append(escape(m.group()[9:].removesuffix("]]>")))
            continue
        tag, attrs = m.group(2).lower(), m.group(3)
        if m.group(1):
            if tag in ("br", "body", "html") and stack[-1].tag == "head":
                pop_to(len(stack) - 1)
            if tag == "br":
                stack[-1].children.append(Node("br"))
            elif tag == "p" and not open_p:
                stack[-1].children.append(Node("p"))
            else:
                i = find((tag,), (TABLE_BOUNDARY if tag in TABLE_PARTS else SCOPE) - {tag})
                if i:
                    pop_to(i)
            continue
        if tag in ("html", "body"):
            stack[0].attrs += attrs if tag == "body" else ""
            if tag == "body":
                pop_to(1)
            continue
        if tag == "head":  # one head, before all else that is visible
            if head or len(stack) > 1 or any(_visible(c) for c in root.children):
                continue
            head = True
        elif stack[-1].tag == "head" and tag not in IN_HEAD:
            pop_to(len(stack) - 1)
        if tag in BREAKOUT:
            while stack[-1].foreign and stack[-1].tag not in HTML_POINTS:
                pop_to(len(stack) - 1)
        foreign = tag in ("svg", "math") or (stack[-1].foreign and stack[-1].tag not in HTML_POINTS)
        if open_p and tag in CLOSES_P:
            i = find(("p",), SCOPE)
            if i:
                pop_to(i)
        if tag in ENDS:
            boundary = BOUNDARY.get(tag, TABLE_BOUNDARY)
            while i := find(ENDS[tag], boundary):
                pop_to(i)
        node = Node(tag, attrs, foreign)
        stack[-1].children.append(node)
        if tag in VOID or (foreign and attrs.endswith("/")):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            node.children.append(html[at:end.start() if end else n])
            at = n if not end else (html.find(">", end.end()) + 1 or n)
        else:
            stack.append(node)
            open_p += tag == "p"
    return root


class _Lines:
    """Text laid out in lines."""

    def __init__(self) -> None:
        self.done: list[str] = []
        self.parts: list[str] = []
        self.space = False
        self.blank = False
        self.indent = ""
        self.mark = ""

    def text(self, text: str, pre: bool) -> None:
        if pre:
            first, *rest = text.replace("\r\n", "\n").split("\n")
            self.parts.append(first)
            for line in rest:
                self.end_line(True)
                self.parts.append(line)
            return
        words = _SPACE.sub(" ", text)
        if not words:
            return
        if words[0] == " ":
            self.space = True
        body = words.strip(" ")
        if body:
            if self.space and self.parts:
                self.parts.append(" ")
            self.parts.append(body)
            self.space = words[-1] == " "

    def end_line(self, keep_empty: bool = False) -> None:
        line = "".join(self.parts).rstrip()
        if line or self.mark or keep_empty:
            if self.blank and self.done:
                self.done.append("")
            self.blank = False
            lead = self.indent[:len(self.indent) - len(self.mark)] + self.mark if self.mark else self.indent
            self.done.append((lead + line).rstrip())
            self.mark = ""
        self.parts, self.space = [], False

    def result(self) -> str:
        self.end_line()
        return "\n".join(self.done).strip("\n")


def _table(rows: list[list[str]]) -> list[str]:
    widths: list[int] = []
    for row in rows:
        for i, cell in enumerate(row):
            if i == len(widths):
                widths.append(0)
            widths[i] = max(widths[i], len(cell))
    return ["  ".join(cell.ljust(widths[i]) for i, cell in enumerate(row)).rstrip() for row in rows]


def render(html: str) -> str:
    """The visible text of a page."""
    lines = _Lines()
    # what is being laid out: (lines, rows of the open table) from the outside in
    outer: list[tuple[_Lines, list]] = []
    lists: list[int | None] = []
    pre = 0
    # part, whether it is left, whether text in it is visible, whether it stands in a drawing outside its text
    walk: list[tuple[Node | str, bool, bool, bool]] = [(build_tree(html), False, True, False)]
    while walk:
        node, leave, visible, drawing = walk.pop()
        if isinstance(node, str):
            if visible and not drawing:
                text = unescape(node) if "&" in node else node
                lines.text(text, pre > 0)
            continue
        tag = node.tag
        if not leave:
            if tag in INVISIBLE or (node.foreign and tag in UNDRAWN):
                continue
            if node.attrs:
                if (now := shown(node.attrs, visible)) is None:
                    continue
                visible = now
            if tag == "br":
                if visible:
                    lines.end_line(True)
                continue
            if tag == "img":
                continue
            if node.foreign:
                drawing = tag == "svg" or (drawing and tag not in ("text", "foreignobject"))
                lines.space |= tag == "text" or tag in MATH_TOKENS
            walk.append((node, True, visible, drawing))
            if tag in ("td", "th") and outer:
                outer.append((lines, []))
                lines = _Lines()
            elif tag == "tr" and outer:
                outer[-1][1].append([])
            elif tag in BLOCKS:
                lines.end_line()
                lines.blank |= tag in SPACED and not (tag in ("ul", "ol") and lists)
                if tag in ("ul", "ol", "menu"):
                    start = _START.match(attributes(node.attrs).get("start", "")) if node.attrs else None
                    lists.append(int(start.group(1)) if start else 1 if tag == "ol" else None)
                    lines.indent += "   " if tag == "ol" else "  "
                elif tag == "li":
                    number = lists[-1] if lists else None
                    if visible:
                        lines.mark = "- " if number is None else f"{number}. "
                    if number is not None:
                        lists[-1] = number + 1
                    if not lists:
                        lines.indent += "  "
                elif tag in ("dd", "blockquote"):
                    lines.indent += "  "
                elif tag == "pre":
                    pre += 1
                elif tag == "table":
                    outer.append((lines, []))
                    lines = _Lines()
            walk.extend((c, False, visible, drawing) for c in reversed(node.children))
            continue
        if tag in ("td", "th") and outer:
            cell = " ".join(lines.result().split())
            lines, _ = outer.pop()
            rows = outer[-1][1]
            if not rows:
                rows.append([])
            rows[-1].append(cell)
        elif tag == "table":
            loose = lines.result()  # captions, and text that stands in no cell
            lines, rows = outer.pop()
            for line in [*loose.split("\n"), *_table([r for r in rows if r])]:
                if line:
                    lines.parts.append(line)
                    lines.end_line()
            lines.blank = True
        elif tag in BLOCKS and not (tag == "tr" and outer):
            lines.end_line()
            lines.blank |= tag in SPACED and not (tag in ("ul", "ol") and len(lists) > 1)
            if tag in ("ul", "ol", "menu"):
                lists.pop()
                lines.indent = lines.indent[:-3 if tag == "ol" else -2]
            elif tag in ("dd", "blockquote") or (tag == "li" and not lists):
                lines.indent = lines.indent[:-2]
            elif tag == "pre":
                pre -= 1
    return lines.result()


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``keep`` columns and ``text``, the visible text of each whole page."""
    n = len(keep)

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            texts = [render(h or "") for h in batch.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n)), pa.array(texts, pa.string())],
                                             names=[*keep, "text"])

    schema = StructType([pages.schema[c] for c in keep]).add("text", StringType())
    return pages.select(*[pages[c] for c in keep], pages[html_col].cast("string").alias(fresh(pages, "__html"))).mapInArrow(batches, schema)
