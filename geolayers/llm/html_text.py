"""Visible text of HTML pages, laid out: blocks, lists and aligned tables."""

import re
from bisect import bisect_left
from collections import Counter
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from geolayers.llm.batches import small_batches

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Never shown, whatever their style.
UNSEEN = set("head title script style template noscript iframe noframes object canvas audio video datalist".split())
# Within svg the text elements are shown, but not what is kept for use elsewhere.
SVG_UNSEEN = set("desc metadata defs symbol clippath mask marker pattern".split())
# Elements of svg and math that hold HTML again, and tags that end svg and math.
HOLDS_HTML = {"svg": {"foreignobject", "desc", "title"}, "math": {"mi", "mo", "mn", "ms", "mtext", "annotation-xml"}}
BREAKS_OUT = set(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
    "ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
# Blocks that keep a blank line around them, and blocks that only begin a new line.
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr menu fieldset".split())
PLAIN = set(
    "html body div section article aside header footer nav main address li dt dd tr td th thead tbody tfoot caption "
    "form figcaption details summary dialog legend option optgroup select textarea center search hgroup".split()
)
BLOCKS = SPACED | PLAIN
# An opening tag closes these open elements, looking no further than the boundary.
TABLE = {"table"}
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"} | TABLE),
    "dt": ({"dt", "dd"}, {"dl"} | TABLE),
    "dd": ({"dt", "dd"}, {"dl"} | TABLE),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
    "td": ({"td", "th", "caption"}, {"tr"} | TABLE),
    "th": ({"td", "th", "caption"}, {"tr"} | TABLE),
    "tr": ({"td", "th", "tr", "caption"}, TABLE),
    "thead": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, TABLE),
    "tbody": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, TABLE),
    "tfoot": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, TABLE),
}
HEAD = set("head title base link meta style script template noscript".split())
CELL_BOUNDS = {"td", "th", "table", "caption"}
GAP = "  "
# A line wider than that does not widen its column: the cells right of it begin in the line below, in their columns.
WIDE = 200
BLANK = re.compile(r"[ \t\n\r\f]+")
OPEN_TAG = re.compile(r"<[a-zA-Z/!?]")
HIDDEN = re.compile(r"display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag, attrs=()):
        self.tag, self.attrs, self.children = tag, dict(attrs), []


class TreeBuilder(HTMLParser):
    """The element tree, with the tags that authors may leave out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.stack = [self.root]
        self.foreign = [""]  # of each open element: the svg or math whose rules hold in it
        self.open = Counter(html=1)

    def pop(self):
        self.open[self.stack.pop().tag] -= 1
        self.foreign.pop()

    def push(self, tag, attrs=()):
        node = Node(tag, attrs)
        self.stack[-1].children.append(node)
        self.stack.append(node)
        kind = self.foreign[-1]
        self.foreign.append(tag if tag in HOLDS_HTML else "" if kind and tag in HOLDS_HTML[kind] else kind)
        self.open[tag] += 1

    def close_within(self, tags, bounds):
        """Close the outermost open element of ``tags`` above the nearest of ``bounds``."""
        if not any(self.open[t] for t in tags):
            return
        at, found = len(self.stack) - 1, None
        while at > 0 and self.stack[at].tag not in bounds:
            if self.stack[at].tag in tags:
                found = at
            at -= 1
        while found is not None and len(self.stack) > found:
            self.pop()

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            self.root.attrs.update(attrs)
            return
        while self.foreign[-1] and tag in BREAKS_OUT:
            self.pop()
        if self.foreign[-1]:
            self.push(tag, attrs)
            return
        if tag == "body":
            self.close_within({"head"}, ())
            if self.open["body"]:
                return
        elif self.open["head"] and tag not in HEAD:
            self.close_within({"head"}, ())
        if tag in BLOCKS:
            self.close_within({"p"}, CELL_BOUNDS)
        if tag in IMPLIED:
            self.close_within(*IMPLIED[tag])
        if tag in ("td", "th") and self.stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self.push("tr")
        if tag in VOID:
            self.stack[-1].children.append(Node(tag, attrs))
        else:
            self.push(tag, attrs)

    def handle_startendtag(self, tag, attrs):
        # The slash means something in svg and math only.
        closed = tag in HOLDS_HTML or (self.foreign[-1] and tag not in BREAKS_OUT and tag != "html")
        self.handle_starttag(tag, attrs)
        if closed:
            self.pop()

    def handle_endtag(self, tag):
        if tag == "br":
            self.stack[-1].children.append(Node("br"))
        elif tag == "p" and not self.open["p"]:
            self.stack[-1].children.append(Node("p"))
        elif self.open[tag] and tag not in ("html", "body"):
            bounds = () if tag in CELL_BOUNDS | {"tr", "thead", "tbody", "tfoot"} else CELL_BOUNDS
            at = len(self.stack) - 1
            while at > 0 and self.stack[at].tag != tag:
                if self.stack[at].tag in bounds:
                    return
                at -= 1
            while at > 0 and len(self.stack) > at:
                self.pop()

    def handle_data(self, data):
        if self.stack[-1].tag == "head":
            if not BLANK.sub("", data):
                return
            self.pop()
        self.stack[-1].children.append(data)

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i, report)


class Canvas:
    """Lines of one flow of blocks: the page, or one table cell."""

    def __init__(self):
        self.lines, self.row, self.gap, self.space = [], [], 0, False
        self.indents = []  # [text of the marker until it is written, width]

    def text(self, data, pre):
        if pre:
            first, *more = data.replace("\r\n", "\n").split("\n")
            self.row.append(first)
            for line in more:
                self.end_line(True)
                self.row.append(line)
            return
        words = BLANK.split(data)
        lead, trail = words[0] == "", words[-1] == ""
        words = [w for w in words if w]
        if lead or not words:
            self.space = True
        if words:
            if self.space and self.row:
                self.row.append(" ")
            self.row.append(" ".join(words))
            self.space = trail

    def end_line(self, keep_empty=False):
        line = "".join(self.row)
        self.row, self.space = [], False
        if line.strip():
            self.put(line)
        elif keep_empty and self.lines:
            self.lines.append("")

    def put(self, line):
        if self.gap and self.lines and self.lines[-1]:
            self.lines.append("")
        self.gap = 0
        prefix = "".join(m[0] if m[0] is not None else " " * m[1] for m in self.indents)
        for m in self.indents:
            m[0] = None
        self.lines.append((prefix + line).rstrip(" "))

    def block(self, spaced):
        if self.row:
            self.end_line()
        self.gap = self.gap or spaced

    def outdent(self):
        self.block(False)
        self.indents.pop()

    def finish(self):
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


class Grid:
    """Cells of a table with their spans."""

    def __init__(self):
        self.rows, self.taken, self.column = [], {}, 0

    def row(self):
        self.rows.append([])
        self.column = 0

    def add(self, lines, colspan, rowspan):
        if not self.rows:
            self.row()
        while self.taken.get(self.column, 0) >= len(self.rows):
            self.column += 1
        column = self.column
        self.rows[-1].append((column, lines, colspan))
        self.column += colspan
        if rowspan > 1:
            for c in range(column, column + colspan):
                self.taken[c] = len(self.rows) + rowspan - 1

    def offsets(self):
        """Where each column begins in which a cell begins. Cells over several columns widen them evenly."""
        starts = sorted({column for row in self.rows for column, _, _ in row})
        widths, spanning = [0] * len(starts), []
        for row in self.rows:
            for column, lines, span in row:
                first, last = bisect_left(starts, column), bisect_left(starts, column + span)
                need = max((len(line) for line in lines if len(line) <= WIDE * (last - first)), default=0)
                if last - first == 1:
                    widths[first] = max(widths[first], need)
                else:
                    spanning.append((last - first, first, need))
        for span, first, need in sorted(spanning):
            surplus = need - sum(widths[first : first + span]) - len(GAP) * (span - 1)
            for k in range(span if surplus > 0 else 0):
                widths[first + k] += surplus // span + (k < surplus % span)
        places, at = {}, 0
        for column, width in zip(starts, widths):
            places[column] = at
            at += width + len(GAP)
        return places

    def lines(self):
        offsets = self.offsets()
        for row in self.rows:
            drawn, widest, below = [], 0, 0  # [length, parts] of each line; where the widest line ends, and the line after the wide ones
            for column, lines, _ in row:
                at = offsets[column]
                # Beside a line that reaches into this column there is no room: the cell begins below it.
                first = below if widest + len(GAP) > at else 0
                for k, line in enumerate(lines, first):
                    while len(drawn) <= k:
                        drawn.append([0, []])
                    if line:
                        drawn[k][1] += [" " * (at - drawn[k][0]), line]
                        drawn[k][0] = at + len(line)
                        if len(line) > WIDE:
                            widest, below = max(widest, drawn[k][0]), max(below, k + 1)
            for _, parts in drawn:
                yield "".join(parts)


def _number(text, default, most):
    return min(int(text), most) if text and text.isascii() and text.isdigit() else default


def render(root: Node) -> str:
    """Lay the tree out. A stack of steps, so depth is no limit."""
    canvases, grids, lists = [Canvas()], [], []
    # A step is (node, shown, pre, svg, None) on the way in, or (None, ..., what to do) on the way out.
    # svg is 0 in HTML, 1 in svg, where bare text is not drawn, and 2 in a text element of svg.
    steps = [(root, True, False, 0, None)]
    while steps:
        node, shown, pre, svg, after = steps.pop()
        canvas = canvases[-1]
        if after is not None:
            after()
            continue
        if isinstance(node, str):
            if shown and svg != 1:
                canvas.text(node, pre)
            continue
        tag, attrs = node.tag, node.attrs
        style = attrs.get("style") or ""
        if svg or tag == "svg":
            style += f";display:{attrs.get('display') or ''};visibility:{attrs.get('visibility') or ''}"
            if svg and tag in SVG_UNSEEN:
                continue
            svg = 1 if tag == "svg" else 0 if tag == "foreignobject" else 2 if tag == "text" else svg
        if tag in UNSEEN or "hidden" in attrs or HIDDEN.search(style) or (tag == "dialog" and "open" not in attrs):
            continue
        seen = VISIBILITY.search(style)
        shown = seen[1].lower() == "visible" if seen else shown
        if tag == "br":
            canvas.end_line(True)
            continue
        if tag == "hr":
            canvas.block(True)
            continue
        children = node.children
        if tag == "details" and "open" not in attrs:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
        pre = pre or tag in ("pre", "textarea")
        leave = []
        if svg == 2 and (tag == "text" or {"x", "y", "dy"} & attrs.keys()):  # drawn at a place of its own
            canvas.space = True
            leave.append(lambda c=canvas: setattr(c, "space", True))
        if tag in BLOCKS:
            spaced = tag in SPACED and not (tag in ("ul", "ol", "menu") and lists)
            canvas.block(spaced)
            leave.append(lambda c=canvas, s=spaced: c.block(s))
        if tag in ("ul", "ol", "menu"):
            lists.append([tag, _number(attrs.get("start"), 1, 1 << 31)])
            leave.append(lists.pop)
        elif tag == "li":
            kind = lists[-1] if lists else ["ul", 1]
            kind[1] = _number(attrs.get("value"), kind[1], 1 << 31)
            mark = f"{kind[1]}. " if kind[0] == "ol" else "- "
            kind[1] += 1
            canvas.indents.append([mark if shown else None, len(mark)])
            leave.append(canvas.outdent)
        elif tag in ("blockquote", "dd"):
            canvas.indents.append([None, 4])
            leave.append(canvas.outdent)
        elif tag == "table":
            grids.append(Grid())

            def drawn(c=canvas):
                for line in grids.pop().lines():
                    c.put(line)

            leave.append(drawn)
        elif tag == "tr" and grids:
            grids[-1].row()
        elif tag in ("td", "th") and grids:
            canvases.append(Canvas())
            spans = _number(attrs.get("colspan"), 1, 1000) or 1, _number(attrs.get("rowspan"), 1, 65534) or 1

            def filled(s=spans):
                grids[-1].add(canvases.pop().finish(), *s)

            leave = [filled]
        # On the way out the last step added comes first: the gap is set behind all else.
        for step in leave:
            steps.append((None, shown, pre, svg, step))
        steps.extend((child, shown, pre, svg, None) for child in reversed(children))
    return "\n".join(canvases[0].finish())


def page_text(html: str) -> str:
    builder = TreeBuilder()
    builder.feed(html)
    if OPEN_TAG.match(builder.rawdata):  # a tag that the page ends in is no text
        builder.rawdata = ""
    builder.close()
    return render(builder.root)


@pandas_udf(T.StringType())
def visible_text(html: pd.Series) -> pd.Series:
    return html.map(lambda h: None if h is None else page_text(h))


def extract_text(pages: DataFrame, id_column: str = "page_id", html_column: str = "html") -> DataFrame:
    """page_id and the page's visible text; one row per row, in no exchange.

    Of svg, its text elements and embedded HTML are shown, each text apart. Hidden: head, scripts, styles and embedded content, ``hidden`` attributes,
    ``display:none`` and ``visibility:hidden`` in style attributes (style sheets are
    not applied), closed ``details`` and ``dialog``. Paragraphs, headings, lists,
    tables and the like have a blank line around them, other blocks a new line.
    List items have a marker and hang below it; every cell begins
    at its column's place, and cells over several columns widen them; right of a line of over ``WIDE`` characters
    a row goes on in the next line. Texts and tables of any length are laid out whole; a page is held by one task. A null page gives null; an empty page or one
    without visible text gives ''; broken markup is read to its end; columns besides
    id and html are not read.
    """
    small_batches(pages.sparkSession)
    return pages.select(F.col(id_column).alias("page_id"), visible_text(F.col(html_column).cast("string")).alias("text"))
