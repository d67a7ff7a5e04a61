"""Layout-aware HTML rendering: a tree builder with implied tags feeds a renderer of all visible text.

The builder tokenises tags, comments, declarations, raw text elements and character references, keeps the stack
of open elements and closes what a start tag or an end tag implies (``p`` before blocks, ``li``, ``dt``/``dd``,
``option``, table rows and cells, ``head`` before text or a tag that cannot stand in it; an end tag closes everything
above its element; stray end tags are ignored).
It calls the renderer as elements open and close, so no tree of the whole page is held and deep nesting needs no
recursion. The renderer leaves out what is not shown (``head``, scripts, styles, templates, the ``hidden``
attribute, ``display:none``, ``visibility:hidden``, hidden inputs, ``noframes`` and ``noembed``, what stands in for
``iframe``, ``object``, ``audio``, ``video`` and ``canvas``, annotations and phantoms of ``math``, ``desc`` and
``metadata`` of ``svg`` and its characters outside ``text``, ``title`` and ``foreignObject``), folds white space except in ``pre``, starts
blocks on lines of their own with an empty line around paragraphs, headings, lists, tables and quotes, marks and
indents list items, numbers ordered ones and pads table cells so that columns line up. Tokens of a formula and
labels of a drawing are set apart by blanks, and so are the options of a ``select``, all of which are rendered with
the labels of their groups (a control shows them when it is opened; those of a ``datalist`` are suggestions and left
out); text in ``defs`` and ``symbol`` is rendered once, where it stands. A cell spans 1,000 columns at most, as
in the standard.

Defined results: a null page is empty and gives an empty text; a page without tags is its text; unknown tags are
inline; tags without an end run to the end of the page; repeated rows are rendered each; columns other than the
id and the page are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import column_bytes, in_arrow

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
ESCAPABLE_RAW = frozenset("textarea title".split())
UNSEEN = frozenset("head script style template title noframes noembed iframe datalist object audio video canvas".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table ul".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir pre blockquote table hr figure fieldset".split())
CLOSES_P = BLOCKS - frozenset("body html dd dt li legend".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = frozenset("base link meta noframes noscript script style template title".split())
# Elements in svg and math: not shown; with HTML inside; tokens of a formula; HTML tags that end the svg or math.
UNSEEN_IN = {"svg": frozenset("desc metadata script style".split()), "math": frozenset("annotation annotation-xml mphantom script style".split())}
HTML_IN = {"svg": frozenset("desc foreignobject title".split()), "math": frozenset("mi mn mo ms mtext annotation-xml".split())}
TOKENS = frozenset("mi mn mo ms mtext".split())
BREAKS = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
#: An opening tag -> the open elements it closes, and the elements that shield them.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
}

# A quote opens a value only right after "="; without its partner, and anywhere else, it is an ordinary character.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+)*+)>|<!--(.*?)(?:-->|\Z)|<[!?/][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?+")
_GONE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_FOLD = re.compile(r"[ \t\r\n\f]+")


@dataclass
class Flow:
    """Lines of text under way: of the page, or of one table cell."""

    lines: list[str] = field(default_factory=list)
    line: str = ""
    gap: bool = False  # white space waits before the next word
    space: bool = False  # an empty line is due before the next text
    indents: list[str] = field(default_factory=list)
    mark: str = ""  # of a list item, before its first line

    def words(self, text: str) -> None:
        parts = _FOLD.split(text)
        if len(parts) > 1 and not parts[0]:
            self.gap = True
        body = " ".join(x for x in parts if x)
        if body:
            self.line += (" " if self.gap and self.line else "") + body
            self.gap = len(parts) > 1 and not parts[-1]

    def raw(self, text: str) -> None:
        first, *rest = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        self.line += first
        for x in rest:
            self.end_line(True)
            self.line += x

    def end_line(self, even_empty: bool = False) -> None:
        text = self.line.rstrip()
        self.line, self.gap = "", False
        if not text and not even_empty:
            return
        self.put(text)

    def put(self, text: str) -> None:
        if self.space and self.lines:
            self.lines.append("")
        self.space = False
        indent = "".join(self.indents)
        if self.mark and text:
            indent = indent[: len(indent) - len(self.mark)] + self.mark
            self.mark = ""
        self.lines.append((indent + text).rstrip())

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.space |= spaced and bool(self.lines)

    def done(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


@dataclass
class Table:
    rows: list[list[tuple[list[str], int]]] = field(default_factory=list)
    caption: list[str] = field(default_factory=list)


def aligned(table: Table) -> list[str]:
    """Rows whose cells begin at the same place in every row; a cell over several columns takes their room."""
    widths: dict[int, int] = {}
    rows = [r for r in table.rows if any(lines for lines, _ in r)]
    for row in rows:
        at = 0
        for lines, span in row:
            if span == 1:
                widths[at] = max(widths.get(at, 0), max(map(len, lines), default=0))
            at += span
    out = list(table.caption)
    for row in rows:
        for k in range(max(len(lines) for lines, _ in row)):
            text, at, column = "", 0, 0
            for lines, span in row:
                text = text.ljust(at) + (lines[k] if k < len(lines) else "")
                at = max(at + sum(widths.get(c, 0) + 2 for c in range(column, min(column + span, len(widths)))), len(text) + 2 if span > 1 else 0)
                column += span
            out.append(text.rstrip())
    return out


class Renderer:
    def __init__(self) -> None:
        self.flows, self.tables = [Flow()], []
        self.lists: list[list] = []  # [tag, next number, indents of its flow]
        self.hidden = self.pre = 0
        self.token = False  # a formula has begun

    def opened(self, tag: str, attributes: dict[str, str], place: str = "") -> bool:
        """Whether the element is hidden; what it holds is then left out. ``place`` is svg, math or HTML (empty)."""
        gone = tag in UNSEEN_IN[place] if place else tag in UNSEEN
        if place or tag == "svg":
            gone |= attributes.get("display") == "none" or attributes.get("visibility") in ("hidden", "collapse")
        if self.hidden or gone or "hidden" in attributes or _GONE.search(attributes.get("style", "")):
            self.hidden += 1
            return True
        flow = self.flows[-1]
        if tag == "math":
            self.token = False
        if place:
            if place == "svg" and tag in ("text", "title") or place == "math" and tag in TOKENS and self.token:
                flow.gap = True
            self.token |= tag in TOKENS
            return False
        if tag in ("select", "optgroup", "option"):
            flow.gap = True
            if tag == "optgroup" and attributes.get("label"):
                self.text(attributes["label"] + " ")
        if tag in BLOCKS:
            flow.block(tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and self.lists))
        if tag in ("ul", "ol", "menu", "dir"):
            start = attributes.get("start", "1")
            self.lists.append([tag, int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1])
        elif tag == "li":
            kind = self.lists[-1] if self.lists else ["ul", 1]
            mark = f"{kind[1]}. " if kind[0] == "ol" else "- "
            kind[1] += 1
            flow.indents.append(" " * len(mark))
            flow.mark = mark
        elif tag in ("dd", "blockquote"):
            flow.indents.append("  ")
        elif tag == "pre":
            self.pre += 1
        elif tag == "table":
            self.tables.append(Table())
        elif tag == "tr" and self.tables:
            self.tables[-1].rows.append([])
        elif tag in ("td", "th", "caption") and self.tables:
            self.flows.append(Flow())
        elif tag == "br":
            flow.end_line(True)
        elif tag == "hr":
            flow.put("---")
            flow.space = True
        elif tag == "input" and attributes.get("type", "").lower() not in ("hidden", "checkbox", "radio", "password", "file", "image"):
            flow.words(attributes.get("value", ""))
        elif tag == "img":
            flow.words(attributes.get("alt", ""))
        return False

    def closed(self, tag: str, hidden: bool, attributes: dict[str, str], place: str = "") -> None:
        if hidden:
            self.hidden -= 1
            return
        flow = self.flows[-1]
        if place:
            if place == "svg" and tag in ("text", "title"):
                flow.gap = True
            return
        if tag in ("td", "th", "caption") and self.tables and len(self.flows) > 1:
            lines = self.flows.pop().done()
            table = self.tables[-1]
            if tag == "caption":
                table.caption += lines
                return
            span = attributes.get("colspan", "1")
            if not table.rows:
                table.rows.append([])
            table.rows[-1].append((lines, min(max(int(span), 1), 1000) if re.fullmatch(r"\d{1,6}", span) else 1))
            return
        if tag in ("select", "optgroup", "option"):
            flow.gap = True
        if tag in BLOCKS:
            flow.block(tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and len(self.lists) > 1))
        if tag in ("ul", "ol", "menu", "dir") and self.lists:
            self.lists.pop()
        elif tag in ("li", "dd", "blockquote") and flow.indents:
            flow.indents.pop()
            flow.mark = ""
        elif tag == "pre":
            self.pre -= 1
        elif tag == "table" and self.tables:
            lines = aligned(self.tables.pop())
            for x in lines:
                flow.put(x)
            flow.space |= bool(lines)

    def text(self, text: str) -> None:
        if not self.hidden:
            self.flows[-1].raw(text) if self.pre else self.flows[-1].words(text)


def render(page: str) -> str:
    """All visible text of a page, lines joined by line feeds."""
    out, stack, at = Renderer(), [], 0  # stack: (tag, hidden, attributes, place of the tag, place and text place inside)
    standing: Counter[str] = Counter()  # open elements by tag

    def pop() -> None:
        standing[stack[-1][0]] -= 1
        out.closed(*stack.pop()[:4])

    def inside() -> tuple[str, bool]:
        """svg, math or HTML (empty), and whether characters are shown there."""
        return stack[-1][4:] if stack else ("", True)

    def break_out() -> None:
        """Close the svg or math around, down to HTML."""
        while inside()[0]:
            pop()

    def close(which: set[str] | frozenset[str], shields: set[str]) -> None:
        """Close the nearest element of ``which`` with all above it, unless a shield stands in between."""
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in which:
                while len(stack) > k:
                    pop()
                close(which, shields) if len(which) > 2 else None  # a row closes its cell first, then itself
                return
            if stack[k][0] in shields or stack[k][3] and not stack[k][4]:  # HTML in svg or math closes nothing around
                return

    def leave_head() -> None:
        """Close an open head that holds the current place, itself or through a noscript."""
        while standing["head"] and stack[-1][0] in ("head", "noscript"):
            pop()

    def text(raw: str) -> None:
        shown = html.unescape(raw)
        if standing["head"] and shown.strip(" \t\r\n\f"):
            leave_head()
        if inside()[1]:
            out.text(shown)

    while at < len(page):
        found = _TAG.search(page, at)
        if not found:
            text(page[at:])
            break
        if found.start() > at:
            text(page[at : found.start()])
        at = found.end()
        if not found[2]:
            if inside()[0] and page.startswith("<![CDATA[", found.start()):
                end = page.find("]]>", found.start())
                raw = page[found.start() + 9 : end if end >= 0 else len(page)]
                if inside()[1]:
                    out.text(raw)
                at = end + 3 if end >= 0 else len(page)
            continue
        tag = found[2].lower()
        if found[1]:
            if tag in ("br", "p"):
                break_out()
            if tag == "br":
                leave_head()
                if out.opened("br", {}):
                    out.hidden -= 1
            elif tag == "p" and not standing["p"]:
                out.closed("p", out.opened("p", {}), {})
            elif standing[tag]:
                shields = {"table"} if tag not in ("table", "body", "html") else set()
                close({tag}, shields - {tag})
            continue
        if standing["head"]:
            if tag in ("head", "html"):
                continue
            if tag not in IN_HEAD:
                leave_head()
        attributes, ended = {}, found[3].endswith("/")
        if found[3].strip(" /"):
            for m in _ATTRIBUTE.finditer(found[3]):
                attributes[m[1].lower()] = html.unescape(m[2] or m[3] or m[4] or "")
                ended = ended and not (m[4] and m.end() == len(found[3]))  # the slash of a value without quotes
        if tag in BREAKS or tag == "font" and not attributes.keys().isdisjoint(("color", "face", "size")):
            break_out()
        place, shown = inside()
        if not place:
            if standing["p"] and tag in CLOSES_P:
                close({"p"}, {"td", "th", "caption", "button", "table"})
            if tag in IMPLIED:
                close(*IMPLIED[tag])
            if tag in HEADINGS and stack and stack[-1][0] in HEADINGS:
                pop()
            if tag == "a" and standing["a"]:
                close({"a"}, {"td", "th", "table"})
            shown = inside()[1]
        hidden = out.opened(tag, attributes, place)
        if place or tag in ("svg", "math"):
            within = "" if tag in HTML_IN.get(place, ()) else tag if tag in ("svg", "math") else place
            shown = within != "svg" or tag == "text" or shown and tag != "svg"
            if ended:
                out.closed(tag, hidden, attributes, place)
                continue
        else:
            within = ""
        if not place and tag in VOID:
            if hidden:
                out.hidden -= 1
            continue
        stack.append((tag, hidden, attributes, place, within, shown))
        standing[tag] += 1
        if (tag in RAW or tag in ESCAPABLE_RAW) and not place or tag in ("script", "style"):
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            inner = page[at : end.start() if end else len(page)]
            out.text(html.unescape(inner) if tag in ESCAPABLE_RAW else inner)
            at = end.end() if end else len(page)
            pop()
    while stack:
        pop()
    return "\n".join(out.flows[0].done())


def extracted(pages: DataFrame, batch_bytes: int = 4 << 20) -> DataFrame:
    """page_id, text: one row per input row."""

    def run(batches):
        for batch in batches:
            raw, lo = column_bytes(batch, "html"), 0
            while lo < len(raw):
                texts, size, hi = [], 0, lo
                while hi < len(raw) and (hi == lo or size + len(raw[hi]) <= batch_bytes):
                    size += len(raw[hi])
                    texts.append(render(raw[hi].decode("utf-8", "replace")))
                    hi += 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([x.encode("utf-8", "replace").decode() for x in texts], pa.string())], names=["page_id", "text"])
                lo = hi

    rows = pages.select("page_id", "html")
    return in_arrow(rows, run, f"page_id {rows.schema['page_id'].dataType.simpleString()}, text string")
