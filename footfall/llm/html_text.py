"""Layout-aware text of HTML pages.

A page is read in three steps: a scanner cuts it into tags and text; a tree
builder turns these into balanced opens and closes, with the start and end
tags that HTML implies and the unmatched ones dropped; a renderer walks the
tree and lays out all visible text: blocks on lines of their own, a blank line
around paragraphs, headings, lists and tables, list markers with indentation,
table cells in columns of equal width, preformatted text as it is.  A cell of
several lines (a list, a table in it) keeps them, side by side with its row's
other cells; one that spans columns widens them all; lines over ALIGN
characters move what follows on their line and do not widen their column.

Visible are also the text of svg and math, the fallback of an object and the
selected option of a select (the first one if none is, all of a multiple one).
Not visible: head, title, script, style, template, noscript and noframes;
iframe, canvas, audio and video, whose content stands for them; datalist;
desc, defs, symbol and metadata of svg, annotations of math; comments;
elements with ``hidden`` or ``display:none``, with ``visibility:hidden`` but
for children made visible again; a dialog or details body that is not open;
hidden inputs.

Depth is kept on explicit stacks, so nesting of any depth is read; time and
memory are in proportion to the page.  Defined results: a null or empty page
has an empty text; malformed pages never fail, an unfinished tag is text;
repeated rows are each rendered; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript title iframe noembed noframes canvas audio video datalist "
                   "desc defs symbol metadata annotation annotation-xml".split())
ALIGN = 100                   # characters of a cell's line that widen its column
SPACED = {t: 1 for t in "p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr fieldset".split()}
BLOCK = frozenset("html body address article aside center dd details dialog dir div dt fieldset figcaption figure "
                  "footer form header hgroup legend li main menu nav section summary caption".split()) | SPACED.keys()
TABLE_PART = frozenset("thead tbody tfoot tr td th caption colgroup".split())
HEAD_ONLY = frozenset("base link meta title style script noscript template head".split())

# start tag -> (open elements it ends, elements beyond which it does not look)
_ITEM = frozenset("ul ol menu dir table td th body".split())
_CELL = frozenset("table".split())
ENDS = {
    "li": (frozenset(["li"]), _ITEM),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl", "table", "td", "th"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl", "table", "td", "th"])),
    "td": (frozenset(["td", "th", "caption", "colgroup"]), _CELL | {"tr"}),
    "th": (frozenset(["td", "th", "caption", "colgroup"]), _CELL | {"tr"}),
    "tr": (frozenset(["tr", "caption", "colgroup"]), _CELL),
    "thead": (frozenset(["thead", "tbody", "tfoot", "caption", "colgroup"]), _CELL),
    "tbody": (frozenset(["thead", "tbody", "tfoot", "caption", "colgroup"]), _CELL),
    "tfoot": (frozenset(["thead", "tbody", "tfoot", "caption", "colgroup"]), _CELL),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
}
_P_SCOPE = frozenset("table td th caption button object".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*')|[^>])*+)>""")
_PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")       # a quote that never ends
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_BLANKS = re.compile(r"[ \t\n\f\r]+")
_HIDING = re.compile(r"display\s*:\s*none", re.I)
_VEIL = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)


def scan(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes); kind is text, open or close."""
    at, n, last = 0, len(html), html.rfind(">")
    while at < n:
        lt = html.find("<", at)
        if lt < 0 or lt > last:                # nothing after the last tag end is a tag
            yield "text", html[at:], ""
            return
        if lt > at:
            yield "text", html[at:lt], ""
        m = _TAG.match(html, lt) or _PLAIN.match(html, lt)
        if m:
            at = m.end()
            name = m[2].lower()
            if m[1]:
                yield "close", name, ""
                continue
            yield "open", name, m[3]
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, at)
                stop = end.start() if end else n
                if name in ("textarea", "xmp") and stop > at:
                    yield "text", html[at:stop], ""
                at = stop
                if not end:
                    return
        elif html.startswith("<!--", lt):
            end = html.find("-->", lt + 4)
            at = n if end < 0 else end + 3
        elif html.startswith(("<!", "<?", "</"), lt):
            end = html.find(">", lt)
            at = n if end < 0 else end + 1
        else:
            yield "text", "<", ""
            at = lt + 1


def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(raw):
        out.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return out


def build(html: str) -> Iterator[tuple[str, str, str]]:
    """The tree as balanced opens and closes in document order."""
    stack: list[str] = []
    count: dict[str, int] = {}

    def push(name, raw):
        stack.append(name)
        count[name] = count.get(name, 0) + 1
        return "open", name, raw

    def pop_through(names, scope):
        """Closes up to the nearest of ``names`` unless ``scope`` is nearer."""
        if not any(count.get(x) for x in names):
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k] in names:
                while len(stack) > k:
                    name = stack.pop()
                    count[name] -= 1
                    yield "close", name, ""
                return
            if stack[k] in scope:
                return

    for kind, name, raw in scan(html):
        if kind == "text":
            if count.get("head") and not name.isspace():
                yield from pop_through({"head"}, ())
            yield kind, name, raw
        elif kind == "open":
            if count.get("head") and name not in HEAD_ONLY:
                yield from pop_through({"head"}, ())
            if name in ("html", "body") and count.get(name):
                continue
            if name in BLOCK and count.get("p"):
                yield from pop_through({"p"}, _P_SCOPE)
            if name in _HEADINGS and stack and stack[-1] in _HEADINGS:
                yield from pop_through({stack[-1]}, ())
            if name in ENDS:
                ended, scope = ENDS[name]
                yield from pop_through(ended, scope)
            if name in ("td", "th") and count.get("table") and (stack[-1] != "tr"):
                if "tr" not in stack[len(stack) - 1 - stack[::-1].index("table"):]:
                    yield push("tr", "")
            yield push(name, raw)
            if name in VOID or raw.endswith("/") and name in ("svg", "math"):
                stack.pop()
                count[name] -= 1
                yield "close", name, ""
        elif name == "p" and not count.get("p"):
            yield "open", "p", ""
            yield "close", "p", ""
        elif name == "br":
            yield "open", "br", ""
            yield "close", "br", ""
        elif count.get(name):
            scope = () if name in ("table", "body", "html") else _CELL if name in TABLE_PART else (
                frozenset(["td", "th", "table"]) if name not in ("td", "th") else _CELL)
            yield from pop_through({name}, scope)
    while stack:
        yield "close", stack.pop(), ""


class Flow:
    """Lines of one box: the page or a table cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap = 0
        self.indents: list[int] = []
        self.marker = ""
        self.pre = 0

    def text(self, s: str) -> None:
        if not self.pre:
            self.parts.append(s)
            return
        first, *rest = s.replace("\r\n", "\n").split("\n")
        self.parts.append(first)
        for line in rest:
            self.end_line(keep=True)
            self.parts.append(line)

    def end_line(self, keep: bool = False) -> None:
        raw = "".join(self.parts)
        self.parts = []
        s = raw.rstrip() if self.pre else _BLANKS.sub(" ", raw).strip(" ")
        s = s.replace("\xa0", " ")
        if not s.strip() and not (keep and self.lines and self.gap == 0):
            return
        if self.gap and self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        room = sum(self.indents)
        if self.marker:
            s = " " * max(0, room - len(self.marker)) + self.marker + s
            self.marker = ""
        elif s:
            s = " " * room + s
        self.lines.append(s)

    def block(self, margin: int = 0) -> None:
        self.end_line()
        self.gap = max(self.gap, margin)

    def done(self) -> str:
        self.end_line()
        while self.lines and not self.lines[-1].strip():
            self.lines.pop()
        return "\n".join(self.lines)


class Grid:
    """Cells of one table, laid out when it ends."""

    def __init__(self):
        self.rows: list[dict[int, tuple[int, list[str]]]] = []       # column -> (columns it spans, lines)
        self.held: dict[int, int] = {}      # column -> rows still covered from above
        self.column = 0

    def row(self) -> None:
        self.rows.append({})
        self.held = {c: n - 1 for c, n in self.held.items() if n > 1}
        self.column = 0

    def cell(self, lines: list[str], across: int, down: int) -> None:
        if not self.rows:
            self.row()
        while self.held.get(self.column):
            self.column += 1
        self.rows[-1][self.column] = across, [x for x in lines if x.strip()]
        if down > 1:
            for c in range(self.column, self.column + across):
                self.held[c] = down
        self.column += across

    def lines(self) -> list[str]:
        width: dict[int, int] = {}
        wide = []
        for r in self.rows:
            for c, (across, text) in r.items():
                size = max((len(x) for x in text if len(x) <= ALIGN), default=1 if text else 0)
                if size and across > 1:
                    wide.append((c, across, size))
                elif size:
                    width[c] = max(width.get(c, 0), size)
        for c, across, size in wide:                                 # a span widens its columns alike
            own = [k for k in range(c, c + across) if k in width] or [c]
            lack = size - sum(width.get(k, 0) for k in own) - 2 * (len(own) - 1)
            for n, k in enumerate(own):
                width[k] = width.get(k, 0) + max(0, lack + len(own) - 1 - n) // len(own)
        used = sorted(width)
        out = []
        for r in self.rows:
            for k in range(max((len(text) for _, text in r.values()), default=0)):
                line, at, end = "", 0, -1                            # at: where the next column begins
                for c in used:
                    across, text = r.get(c, (1, []))
                    if c > end:
                        end = c + across - 1
                        if k < len(text):
                            line = line.ljust(at) + text[k] if len(line) <= at else f"{line}  {text[k]}"
                    at += width[c] + 2
                out.append(line.rstrip())
        return [x for x in out if x]


def _span(attrs: dict[str, str], name: str) -> int:
    value = attrs.get(name, "1").strip()
    return min(int(value), 1000) if value.isascii() and value.isdigit() and len(value) < 6 and int(value) else 1


def render(html: str) -> str:
    """All visible text of a page, laid out."""
    flow, flows = Flow(), []                    # flows: boxes around the current one
    grids: list[Grid] = []
    cells: list[tuple[int, int]] = []
    lists: list[list] = []                      # [is ordered, next number]
    hidden = 0                                  # opens inside a hidden element
    shut: list[int] = []                        # depths of details that are not open
    veils = [False]                             # visibility of the open elements, hidden ones apart
    selects: list[tuple[bool, list[tuple[bool, str]]]] = []
    depth = 0
    for kind, name, raw in build(html):
        if kind == "text":
            if not hidden and not veils[-1] and not (shut and depth == shut[-1]):
                flow.text(unescape(name) if "&" in name else name)
            continue
        if kind == "open":
            depth += 1
            attrs = attributes(raw) if raw and raw != "/" else {}
            if hidden or name in UNSEEN or "hidden" in attrs or _HIDING.search(attrs.get("style", "")) or (
                    name == "dialog" and "open" not in attrs) or (
                    shut and depth == shut[-1] + 1 and name != "summary"):
                hidden += 1
                continue
            veil = _VEIL.search(attrs.get("style", ""))
            veils.append(veil[1].lower() != "visible" if veil else veils[-1])
            if name == "details" and "open" not in attrs:
                shut.append(depth)
            if name == "select":                # its options are boxes, one of which is shown
                flows.append(flow)
                flow = Flow()
                selects.append(("multiple" in attrs, []))
            elif name == "option" and selects:
                flows.append(flow)
                flow = Flow()
                selects[-1][1].append(("selected" in attrs, ""))
            elif name == "br":
                flow.end_line(keep=True)
            elif name in ("td", "th") and grids:
                flows.append(flow)
                flow = Flow()
                cells.append((_span(attrs, "colspan"), _span(attrs, "rowspan")))
            elif name == "tr" and grids:
                grids[-1].row()
            elif name in BLOCK:
                flow.block(0 if name in ("ul", "ol") and lists else SPACED.get(name, 0))
                if name in ("ul", "ol", "menu", "dir"):
                    lists.append([name == "ol", int(attrs["start"]) if attrs.get("start", "").isascii()
                                  and attrs.get("start", "").isdigit() and len(attrs["start"]) < 10 else 1])
                elif name == "li":
                    marker = "- "
                    if lists and lists[-1][0]:
                        marker = f"{lists[-1][1]}. "
                        lists[-1][1] += 1
                    flow.indents.append(len(marker))
                    flow.marker = marker
                elif name in ("dd", "blockquote"):
                    flow.indents.append(4)
                elif name == "pre":
                    flow.pre += 1
                elif name == "table":
                    grids.append(Grid())
            elif name == "input" and not veils[-1] and attrs.get("type", "text").lower() in ("submit", "button", "reset"):
                flow.text(attrs.get("value", ""))
            continue
        # close
        depth -= 1
        if hidden:
            hidden -= 1
            continue
        veils.pop()
        if shut and shut[-1] == depth + 1:
            shut.pop()
        if name == "option" and selects:
            selects[-1][1][-1] = selects[-1][1][-1][0], flow.done().replace("\n", " ")
            flow = flows.pop()
        elif name == "select" and selects:
            flow = flows.pop()
            several, options = selects.pop()
            shown = [t for _, t in options] if several else [t for s, t in options if s][-1:] or [t for _, t in options][:1]
            flow.parts.append(" ".join(shown))
        elif name in ("td", "th") and grids and cells:
            across, down = cells.pop()
            text, flow = flow.done(), flows.pop()
            grids[-1].cell(text.split("\n"), across, down)
        elif name == "table" and grids:
            flow.block(1)
            for line in grids.pop().lines():
                flow.pre += 1
                flow.parts = [line]
                flow.end_line()
                flow.pre -= 1
            flow.block(1)
        elif name in BLOCK:
            flow.block(0 if name in ("ul", "ol") and len(lists) > 1 else SPACED.get(name, 0))
            if name in ("ul", "ol", "menu", "dir") and lists:
                lists.pop()
            elif name in ("li", "dd", "blockquote") and flow.indents:
                flow.indents.pop()
                flow.marker = "" if name == "li" else flow.marker
            elif name == "pre":
                flow.pre -= 1
    while flows:
        flow = flows.pop()
    return flow.done()


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, n_chars, text) for every row of ``pages``."""
    src = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [render(h.as_py()) for h in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(map(len, texts)), pa.int64()), pa.array(texts, pa.string())],
                names=["page_id", "n_chars", "text"])

    kind = src.schema["page_id"].dataType.simpleString()
    return src.mapInArrow(run, f"page_id {kind}, n_chars bigint, text string")


def query(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))
