"""Visible text of HTML pages, laid out like a browser would.

A tree builder (``build``) handles void elements and implied tags: a block start closes an open
paragraph; li, dt/dd, option, tr, td and row groups close their open siblings; a cell without a row opens one;
an end tag closes what is open inside it, and one that matches nothing is ignored. The renderer walks the
tree without recursion. Invisible are head, script, style, template, noscript and other elements without
rendering, ``hidden``, ``display:none``, ``visibility:hidden`` (a visible descendant shows again), closed
details but for their summary, closed dialogs and hidden inputs. Of SVG the text in ``text`` and ``foreignObject`` elements is rendered, each a block;
MathML text stands in its line, without annotations and phantoms. Blanks collapse except in pre and
textarea; blocks start new lines, paragraphs, headings, lists and tables stand between blank lines; list
items get bullets or numbers and indent; the cells of a table are aligned in columns (cells wider than
``MAX_PAD`` are not padded to, which bounds the output). Lists and quotes nested more than 20 deep indent no further, and a
cell spans at most 100 columns; no text is lost by either.

Defined cases: a null page has null text, an empty one the empty text; malformed markup gives what can be
read (an unknown ``<!`` is a comment up to the next ``>``, CDATA is text in SVG and MathML only; numbers are read as
far as they are ASCII digits); repeated rows are rendered each; an empty table gives no rows; other columns pass through."""

from __future__ import annotations

import re
from bisect import bisect_right
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template noscript iframe object audio video canvas datalist noframes title".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr fieldset".split())
BLOCK = SPACED | frozenset("""address article aside body center dd details dialog dir div dt figcaption footer form header
hgroup html legend li main menu nav option optgroup section summary caption tr tbody thead tfoot""".split())
#: start tag -> open tags it closes, and the tags beyond which it does not look
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": ({"td", "th", "caption"}, {"table", "tr"}),
    "th": ({"td", "th", "caption"}, {"table", "tr"}),
    **{t: ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}) for t in ("thead", "tbody", "tfoot")},
}
SCOPE = frozenset({"table", "td", "th", "caption", "button"})
#: In SVG and MathML: not rendered; where HTML begins again; and HTML tags that end the SVG or MathML.
UNDRAWN = {"svg": frozenset("defs symbol clippath mask marker pattern lineargradient radialgradient filter desc metadata".split()),
           "math": frozenset("annotation annotation-xml mphantom".split())}
INTEGRATION = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
BREAKOUT = frozenset("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing
menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var""".split())
MAX_PAD = 40
_BLANK = re.compile(r"[ \t\n\r\f]+")
_INT = re.compile(r"[ \t\n\r\f]*([+-]?)(?=[0-9])0*([0-9]*)")
_LONG_REF = re.compile(r"&#0*([0-9]{8})[0-9]*")
#: Declarations of a style: semicolons in quotes and brackets part nothing.
_DECLARATION = re.compile(r"""(?:[^;"'(]|"[^"]*"?|'[^']*'?|\([^)]*\)?)+""")
_COMMENT = re.compile(r"/\*.*?(?:\*/|$)", re.S)


def _number(s: str, large: int) -> int | None:
    """The whole number that an attribute begins with, ``large`` beyond nine digits; None without one."""
    m = _INT.match(s)
    return None if m is None else large if len(m[2]) > 9 else int(m[1] + (m[2] or "0"))


def _style(text: str) -> dict[str, str]:
    """property -> value of a style attribute, lower-cased; the last one counts, and before all an important one."""
    out, fixed = {}, set()
    for d in _DECLARATION.findall(_COMMENT.sub(" ", text.lower())):
        name, _, value = d.partition(":")
        name, (value, bang, _) = name.strip(), value.partition("!")
        if bang or name not in fixed:
            out[name] = value.strip()
        if bang:
            fixed.add(name)
    return out


class Node:
    """``foreign``: "svg" in an SVG, "text" in a text of it, "math" in MathML, else empty."""

    __slots__ = ("tag", "attrs", "children", "parent", "foreign")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent
        was = parent.foreign if parent else ""
        self.foreign = (tag if tag in ("svg", "math") else "" if was and tag == "foreignobject" else
                        "text" if was == "svg" and tag == "text" else was)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)
        self.path: list[Node] = []             # open elements, the root's child first
        self.depth: dict[str, list[int]] = {}  # where the open elements of a tag stand in it: no tag needs a walk

    def _close(self, at: int) -> None:
        """The open element at ``at`` and all in it."""
        self.at = self.path[at].parent
        for n in self.path[at:]:
            self.depth[n.tag].pop()
        del self.path[at:]

    def _nearest(self, tags) -> int:
        """Place of the innermost open element of these tags, -1 without one."""
        return max((self.depth[t][-1] for t in tags if self.depth.get(t)), default=-1)

    def _close_open(self, tags, stops) -> None:
        mine = [x for x in map(self.depth.get, tags) if x]
        if not mine:
            return
        stop = self._nearest(stops)
        inside = [x[i] for x in mine if (i := bisect_right(x, stop)) < len(x)]
        if inside:
            self._close(min(inside))

    def _open(self, tag: str, attrs: dict) -> None:
        node = Node(tag, attrs, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node
            self.depth.setdefault(tag, []).append(len(self.path))
            self.path.append(node)

    def handle_starttag(self, tag, attrs):
        if self.at.foreign and tag in BREAKOUT:
            self._close_open({"svg", "math"}, INTEGRATION)
        if tag in ("html", "body") and self.depth.get(tag):
            return
        if self.depth.get("head") and (tag in BLOCK or tag in ("a", "span", "img")):
            self._close_open({"head"}, ())  # the body begins though head was not closed
        if tag in IMPLIED:
            self._close_open(*IMPLIED[tag])
        if tag in BLOCK and tag not in ("html", "body"):
            self._close_open({"p"}, SCOPE)
        if tag in ("td", "th") and self.depth.get("table") and self.at.tag != "tr":
            self._open("tr", {})
        self._open(tag, {k: v or "" for k, v in attrs})

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if self.at.tag == tag and (self.at.foreign or tag == "foreignobject") and tag not in VOID:
            self._close(len(self.path) - 1)  # elements of SVG and MathML may close themselves

    def parse_html_declaration(self, i):
        """Never raises: what is no comment, CDATA or doctype is a comment up to the next ``>``."""
        data = self.rawdata
        cdata = data.startswith("<![CDATA[", i) and self.at.foreign
        end = data.find("]]>" if cdata else ">", i)
        if cdata:
            self.handle_data(data[i + 9:end if end >= 0 else len(data)])
        return len(data) if end < 0 else end + (3 if cdata else 1)

    def handle_endtag(self, tag):
        if tag == "br":
            self._open("br", {})
        if not self.depth.get(tag) or tag in VOID:
            return
        at = self.depth[tag][-1]
        if tag in ("table", "tr", "tbody", "thead", "tfoot", "html", "body") or self._nearest(SCOPE - {tag}) < at:
            self._close(at)

    def handle_data(self, data):
        self.at.children.append(data)


def build(html: str) -> Node:
    b = _Builder()
    last = html.rfind("<")
    if last >= 0 and html.find(">", last) < 0 and re.match(r"</?[A-Za-z]", html[last:last + 3]):
        html = html[:last]  # a tag that the page ends in
    b.feed(_LONG_REF.sub(r"&#\1", html))  # all beyond Unicode, but not beyond int()
    b.close()
    return b.root


class _Flow:
    """Lines of text with collapsed blanks, pending breaks and indents."""

    def __init__(self):
        self.lines, self.cur, self.space, self.gap, self.indent, self.bullet = [], [], False, 0, [], None

    def _begin(self):
        if not self.cur:
            if self.lines and self.gap > 1:
                self.lines.append("")
            self.gap = 0
            lead = "".join(self.indent)
            if self.bullet is not None:
                lead, self.bullet = "".join(self.indent[:-1]) + self.bullet, None
            self.cur.append(lead)
            self.space = False

    def text(self, s: str, keep: bool):
        if keep:
            parts = s.replace("\r\n", "\n").split("\n")
            for i, p in enumerate(parts):
                if i:
                    self.line()
                if p:
                    self._begin()
                    self.cur.append(p)
            return
        words = _BLANK.split(s)
        body = " ".join(w for w in words if w)
        if not body:
            self.space = self.space or bool(s)
            return
        fresh = not self.cur
        self._begin()
        if not fresh and (self.space or not words[0]):
            self.cur.append(" ")
        self.cur.append(body)
        self.space = not words[-1]

    def line(self):
        """Ends the line, even an empty one (br)."""
        if not self.cur and self.gap > 1 and self.lines:
            self.lines.append("")
            self.gap = 0
        self.lines.append("".join(self.cur).rstrip())
        self.cur, self.space = [], False

    def block(self, gap: int):
        if self.cur:
            self.line()
        self.gap, self.space = max(self.gap, gap), False

    def done(self) -> list[str]:
        if self.cur:
            self.line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        while self.lines and not self.lines[0]:
            self.lines.pop(0)
        return self.lines


def _aligned(rows: list[list[list[str]]]) -> list[str]:
    rows = [r for r in rows if any(c for c in r)]
    if all(len(r) < 2 for r in rows):  # a table for layout only
        return [x for r in rows for c in r for x in c]
    wide: list[int] = []
    for r in rows:
        for i, cell in enumerate(r):
            if i == len(wide):
                wide.append(0)
            wide[i] = max(wide[i], max((len(x) for x in cell if len(x) <= MAX_PAD), default=0))
    out = []
    for r in rows:
        for k in range(max((len(c) for c in r), default=0)):
            out.append(" | ".join((c[k] if k < len(c) else "").ljust(wide[i]) for i, c in enumerate(r)).rstrip())
    return out


def _shown(node: Node, visible: bool) -> tuple[bool, bool]:
    """(rendered at all, text visible)."""
    a, tag = node.attrs, node.tag
    if tag in HIDDEN or "hidden" in a or tag == "dialog" and "open" not in a or tag == "input" and a.get("type", "").lower() == "hidden":
        return False, False
    if tag in UNDRAWN.get("svg" if node.foreign == "text" else node.foreign, ()):
        return False, False
    style = _style(a["style"]) if "style" in a else {}
    if style.get("display") == "none":
        return False, False
    if style.get("visibility") in ("hidden", "collapse"):
        visible = False
    elif style.get("visibility") in ("visible", "initial"):
        visible = True
    return True, visible


def _is_block(node: Node) -> bool:
    return node.tag in BLOCK or node.tag == "text" and node.foreign == "text" or node.tag == "foreignobject"


def render(root: Node) -> str:
    flow, flows, tables, lists = _Flow(), [], [], []
    todo: list = [(root, True, False)]
    while todo:
        item = todo.pop()
        if len(item) == 2:  # leaving a node
            node, was = item
            tag = node.tag
            if tag in ("td", "th") and tables:
                cell = flow.done()
                flow = flows.pop()
                if not tables[-1]:
                    tables[-1].append([])
                span = _number(node.attrs.get("colspan", ""), 100) or 1
                tables[-1][-1] += [cell] + [[]] * (min(span, 100) - 1 if span > 1 else 0)
            elif tag == "table":
                rows = tables.pop()
                flow.block(2)
                for x in _aligned(rows):
                    flow.text(x, True)
                    flow.line()
                flow.block(2)
            elif tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
                flow.block(1 if lists else 2)
            elif tag == "li":
                flow.bullet = None
                flow.indent.pop()
                flow.block(1)
            elif tag in ("blockquote", "dd"):
                flow.indent.pop()
                flow.block(2 if tag == "blockquote" else 1)
            elif _is_block(node):
                flow.block(2 if tag in SPACED else 1)
            continue
        node, visible, keep = item
        if isinstance(node, str):
            in_rows = tables and not flows or len(flows) < len(tables)
            if visible and not (in_rows and not node.strip()):
                flow.text(node, keep)
            continue
        shown, visible = _shown(node, visible)
        if not shown:
            continue
        tag = node.tag
        if tag == "br":
            flow.line()
            continue
        if _is_block(node):
            flow.block(2 if tag in SPACED and not (tag in ("ul", "ol") and lists) else 1)
        if tag in ("ul", "ol", "menu", "dir"):
            start = _number(node.attrs.get("start", ""), 1)
            lists.append(None if tag != "ol" else 1 if start is None else start)
        elif tag == "li":
            mark = "- "
            if lists and lists[-1] is not None:
                mark, lists[-1] = f"{lists[-1]}. ", lists[-1] + 1
            flow.indent.append(" " * len(mark) if len(flow.indent) < 20 else "")
            flow.bullet = mark
        elif tag in ("blockquote", "dd"):
            flow.indent.append("  " if len(flow.indent) < 20 else "")
        elif tag == "table":
            tables.append([])
        elif tag == "tr" and tables:
            tables[-1].append([])
        elif tag in ("td", "th"):
            if tables:
                flows.append(flow)
                flow = _Flow()
            elif flow.cur:
                flow.space = True
        todo.append((node, visible))
        keep = keep or tag in ("pre", "textarea", "xmp", "listing")
        inside = node.children
        if tag == "details" and "open" not in node.attrs:
            inside = [c for c in inside if not isinstance(c, str) and c.tag == "summary"]
        if node.foreign == "svg":
            inside = [c for c in inside if not isinstance(c, str)]  # only text elements draw text
        todo.extend((c, visible, keep) for c in reversed(inside))
    return "\n".join(flow.done())


def visible_text(html: str | None) -> str | None:
    return None if html is None else render(build(html))


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(row: the input's columns, text) per page."""
    udf = F.pandas_udf(lambda s: pd.Series([visible_text(x) for x in s], dtype=object), "string")
    return pages.select(F.struct(*[pages[c] for c in pages.columns]).alias("row"), udf(pages[html_col]).alias("text"))
