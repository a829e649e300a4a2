"""HTML structure scan as one Arrow-batched UDF that gives an interval index, and native views of it.

The only Python on the hot path.  One loop over a page's events (plain markup is cut by one pattern, the stdlib parser
goes on where other markup begins) numbers the elements in document order and
writes flat lists: visible strings, table rows, cells, badges, list items, headings and what follows them.  An
element's descendants of any kind stand together in that kind's list, so a table is a range of rows, a row a range of
cells, a cell a range of strings, and a heading a range of the items behind it.  The index is linear in the page
however deep or unclosed its tags are; there is no tree and no recursion.

``tables_of``, ``heading_text`` and ``followers`` cut those ranges with native array expressions.  ``select_ranges``
evaluates descendant selectors (``div.panel-box table tbody tr``) in the same kind of scan.
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import bind, collapse_ws, ustrip


def _ints(*names: str, tag: bool = False) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField("tag", T.StringType())] * tag + [T.StructField(n, T.IntegerType()) for n in names]))


# ranges are [a, b) into another list; open and close are element numbers: x lies inside e if e.open < x.open < e.close
PAGE = T.StructType([
    T.StructField("strings", T.ArrayType(T.StringType())),                                   # visible text nodes
    T.StructField("tables", _ints("open", "rows_a", "rows_b", "groups_a", "groups_b")),
    T.StructField("groups", _ints("open", "close", tag=True)),                               # thead, tbody, tfoot
    T.StructField("rows", _ints("open", "cells_a", "cells_b")),
    T.StructField("cells", _ints("a", "b", "badges_a", "badges_b", tag=True)),
    T.StructField("badges", _ints("a", "b")),
    T.StructField("headings", _ints("open", "a", "b", "items_a", "items_b", tag=True)),
    T.StructField("items", _ints("a", "b", tag=True)),                                       # text, p or list (a range of lis)
    T.StructField("lis", _ints("a", "b")),
    T.StructField("error", T.StringType()),
])
SELECTED = T.StructType([
    T.StructField("strings", T.ArrayType(T.StringType())),
    T.StructField("hits", T.ArrayType(_ints("open", "close", "a", "b"))),                    # one list for each selector
])

# ---- fixed values: HTML void elements and ignored raw-text containers ----------------------
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
        "track", "wbr"}
HIDDEN = {"script", "style", "template"}
HEADING_TAGS = {"h2", "h3", "h4", "strong", "b"}
STOP_TAGS = {"h2", "h3", "h4"}
GROUP_TAGS = {"thead", "tbody", "tfoot"}

# plain markup, on which every version of the stdlib parser agrees: text, tags with quoted attributes, a doctype, a comment
_S = r"[ \t\n\r\f]"
_PLAIN = re.compile(rf"""([^<]+)|<(/?)([A-Za-z][A-Za-z0-9]*)((?:{_S}+[A-Za-z][A-Za-z0-9-]*=(?:"[^"]*"|'[^']*'))*){_S}*(/?)>"""
                    r"|<![Dd][Oo][Cc][Tt][Yy][Pp][Ee] [^<>]*>|<!--[^<>-](?:[^<>-]|-(?!-))*-->")
# the same for a tag and the text behind it, or an element that holds nothing but text and the text behind it, in one step
_STEP = re.compile(rf"""<(/)?([A-Za-z][A-Za-z0-9]*+)((?:{_S}++[A-Za-z][A-Za-z0-9-]*+=(?:"[^"]*+"|'[^']*+'))*+){_S}*+(/?)>([^<]*+)(?(1)|(?:(</\2>)([^<]*+))?)"""
                   r"|([^<]++)|<![Dd][Oo][Cc][Tt][Yy][Pp][Ee] [^<>]*>|<!--[^<>-](?:[^<>-]|-(?!-))*-->|(<)")
_ATTRIBUTE = re.compile(r"""([A-Za-z][A-Za-z0-9-]*)=(?:"([^"]*)"|'([^']*)')""")
_OPEN = re.compile("<")
_RAW_END = re.compile(r"</\s*(?:script|style)|<!--", re.I)
# elements whose content some version of the parser does not read as markup
_RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "noscript", "xmp", "plaintext", "svg", "math"}
_BADGED = {"span", "div"}      # elements whose class says whether they are badges
_LISTS = {"ul", "ol"}
_LEAVES = {"td", "th", "li", "p"}
_INDEXED = HEADING_TAGS | GROUP_TAGS | {"table", "tr", "td", "th", "li", "span", "div", "p", "ul", "ol"}
PAGES_AT_ONCE = 64             # pages whose lists a task holds as Python objects


def _attributes(text: str) -> list[tuple[str, str]]:
    return [(k.lower(), unescape(a or b)) for k, a, b in _ATTRIBUTE.findall(text)] if text else []


class _Events(HTMLParser):
    """Element numbers, visible strings and balanced open/close calls for every element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.n, self.hidden = 0, 0
        self.strings: list[str] = []
        self.stack: list[tuple] = []                  # (tag, what ``opened`` returned)
        self.counts: dict[str, int] = {}              # open elements by tag: a stray end tag costs nothing

    def opened(self, tag: str, attrs: list, number: int):
        raise NotImplementedError

    def closed(self, tag: str, state) -> None:
        raise NotImplementedError

    def text(self, at: int) -> None:
        pass

    def handle_starttag(self, tag, attrs):
        number = self.n
        self.n = number + 1
        self.stack.append((tag, self.opened(tag, attrs, number)))
        self.counts[tag] = self.counts.get(tag, 0) + 1
        if tag in HIDDEN:
            self.hidden += 1
        if tag in VOID:
            self._pop()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._pop()
            if tag in self.CDATA_CONTENT_ELEMENTS:
                self.clear_cdata_mode()

    def handle_endtag(self, tag):
        while self.counts.get(tag, 0) and self._pop() != tag:
            pass

    def handle_data(self, data):
        if not self.hidden:
            self.strings.append(data)
            self.text(len(self.strings) - 1)

    def run(self, html: str):
        self.feed(html[self._plain(html):])
        self.close()
        while self.stack:
            self._pop()
        return self

    def _plain(self, html: str) -> int:
        """Make the parser's calls for the page's plain markup; where other markup begins, the parser goes on."""
        match, i, n = _PLAIN.match, 0, len(html)
        while i < n:
            m = match(html, i)
            if m is None:
                break
            text, end, tag, attrs, shut = m.groups()
            to = m.end()
            if text is not None:
                self.handle_data(unescape(text) if "&" in text else text)
            elif tag is not None:
                tag = tag.lower()
                if end:
                    if attrs or shut:
                        break
                    self.handle_endtag(tag)
                elif tag not in _RAW:
                    (self.handle_startendtag if shut else self.handle_starttag)(tag, _attributes(attrs))
                else:                                  # its content has to be plain, too
                    stop = (_RAW_END if tag in ("script", "style") else _OPEN).search(html, to)
                    close = f"</{tag}>"
                    if stop is None or attrs or shut or tag not in ("script", "style", "title") or not html.startswith(close, stop.start()):
                        break
                    self.handle_starttag(tag, [])
                    if stop.start() > to:
                        self.handle_data(unescape(html[to:stop.start()]) if tag == "title" else html[to:stop.start()])
                    self.handle_endtag(tag)
                    to = stop.start() + len(close)
            i = to
        return i

    def _pop(self) -> str:
        tag, state = self.stack.pop()
        self.counts[tag] -= 1
        if tag in HIDDEN:
            self.hidden -= 1
        self.closed(tag, state)
        return tag


class _Index(_Events):
    def __init__(self):
        super().__init__()
        self.tables, self.groups, self.rows, self.cells, self.badges = [], [], [], [], []
        self.headings, self.items, self.lis = [], [], []
        self.children: list[list | None] = [None]     # per open element: its headings and what follows them

    def opened(self, tag, attrs, number):
        self.children.append(None)
        if tag not in _INDEXED:
            return None
        rec = None
        if tag == "table":
            rec = {"open": number, "rows_a": len(self.rows), "groups_a": len(self.groups)}
            self.tables.append(rec)
        elif tag in GROUP_TAGS:
            rec = {"tag": tag, "open": number}
            self.groups.append(rec)
        elif tag == "tr":
            rec = {"open": number, "cells_a": len(self.cells)}
            self.rows.append(rec)
        elif tag in ("td", "th"):
            rec = {"tag": tag, "a": len(self.strings), "badges_a": len(self.badges)}
            self.cells.append(rec)
        elif tag == "li":
            rec = {"a": len(self.strings)}
            self.lis.append(rec)
        elif tag in HEADING_TAGS:
            rec = {"tag": tag, "open": number, "a": len(self.strings)}
            self.headings.append(rec)
        elif tag in ("span", "div"):
            cls = next((v or "" for k, v in attrs if k == "class"), "")
            if ("badge" in cls) if tag == "span" else ("badge" in cls.split()):
                rec = {"a": len(self.strings)}
                self.badges.append(rec)
        elif tag == "p":
            rec = {"a": len(self.strings)}
        elif tag in ("ul", "ol"):
            rec = {"a": len(self.lis)}
        return rec

    def closed(self, tag, rec):
        kids = self.children.pop()
        if kids is not None:
            self._follow(kids)
        if rec is not None:
            self._end(tag, rec)

    def _end(self, tag, rec):
        if tag == "td" or tag == "th":
            rec["b"] = len(self.strings)
            rec["badges_b"] = len(self.badges)
        elif tag == "tr":
            rec["cells_b"] = len(self.cells)
        elif tag in _LISTS:
            up = self.children[-1]
            if up is not None:
                up.append({"tag": "list", "a": rec["a"], "b": len(self.lis)})
        elif tag == "table":
            rec["rows_b"] = len(self.rows)
            rec["groups_b"] = len(self.groups)
        elif tag in GROUP_TAGS:
            rec["close"] = self.n
        else:                                         # p, li, a badge or a heading
            rec["b"] = len(self.strings)
            up = self.children[-1]
            if tag == "p":
                if up is not None:
                    up.append({"tag": "p", **rec})
            elif tag in HEADING_TAGS:
                if up is None:
                    self.children[-1] = [rec]
                else:
                    up.append(rec)

    def _plain(self, html):
        """As in the base class, a tag with the text behind it at once, the index's own steps in place of the parser's calls."""
        strings, stack, counts, children = self.strings, self.stack, self.counts, self.children
        rows, cells, badges, lis = self.rows, self.cells, self.badges, self.lis
        i, more = 0, True
        while more:
            more = False
            for m in _STEP.finditer(html, i):
                end, tag, attrs, shut, text, leaf, behind, alone, other = m.groups()
                if tag is None:
                    if other:
                        return m.start()
                    text = alone
                elif end:
                    if attrs or shut:
                        return m.start()
                    if tag not in counts:
                        tag = tag.lower()
                    while counts.get(tag, 0):
                        t, rec = stack.pop()
                        counts[t] -= 1
                        if t in HIDDEN:
                            self.hidden -= 1
                        kids = children.pop()
                        if kids is not None:
                            self._follow(kids)
                        if rec is not None:
                            self._end(t, rec)
                        if t == tag:
                            break
                elif leaf and tag in _LEAVES and not shut:
                    self.n += 1
                    at = len(strings)
                    if text and not self.hidden:
                        strings.append(unescape(text) if "&" in text else text)
                    if tag == "td" or tag == "th":
                        cells.append({"tag": tag, "a": at, "b": len(strings), "badges_a": len(badges), "badges_b": len(badges)})
                    elif tag == "li":
                        lis.append({"a": at, "b": len(strings)})
                    elif children[-1] is not None:
                        children[-1].append({"tag": "p", "a": at, "b": len(strings)})
                    text = behind
                else:
                    if not tag.islower():
                        tag = tag.lower()
                    if tag in _RAW:                    # its content has to be plain, too
                        to = m.start(5)
                        stop = (_RAW_END if tag in ("script", "style") else _OPEN).search(html, to)
                        if stop is None or attrs or shut or tag not in ("script", "style", "title") or not html.startswith(f"</{tag}>", stop.start()):
                            return m.start()
                        self.handle_starttag(tag, [])
                        if stop.start() > to:
                            self.handle_data(unescape(html[to:stop.start()]) if tag == "title" else html[to:stop.start()])
                        self.handle_endtag(tag)
                        i, more = stop.start() + len(tag) + 3, True
                        break
                    if leaf:
                        (self.handle_startendtag if shut else self.handle_starttag)(tag, _attributes(attrs))
                        if text:
                            self.handle_data(unescape(text) if "&" in text else text)
                        self.handle_endtag(tag)
                        text = behind
                    elif tag in VOID:
                        self.n += 1
                    elif shut or tag in HIDDEN:
                        (self.handle_startendtag if shut else self.handle_starttag)(tag, _attributes(attrs))
                    else:
                        rec = None
                        if tag == "td" or tag == "th":
                            rec = {"tag": tag, "a": len(strings), "badges_a": len(badges)}
                            cells.append(rec)
                            children.append(None)
                        elif tag == "p":
                            rec = {"a": len(strings)}
                            children.append(None)
                        elif tag == "tr":
                            rec = {"open": self.n, "cells_a": len(cells)}
                            rows.append(rec)
                            children.append(None)
                        elif tag == "li":
                            rec = {"a": len(strings)}
                            lis.append(rec)
                            children.append(None)
                        elif tag in _INDEXED and (attrs or tag not in _BADGED):
                            rec = self.opened(tag, _attributes(attrs), self.n)
                        else:
                            children.append(None)
                        self.n += 1
                        stack.append((tag, rec))
                        counts[tag] = counts.get(tag, 0) + 1
                if text and not self.hidden:
                    strings.append(unescape(text) if "&" in text else text)
                    kids = children[-1]
                    if kids is not None:
                        kids.append({"tag": "text", "a": len(strings) - 1, "b": len(strings)})
        return len(html)

    def text(self, at):
        if self.children[-1] is not None:
            self.children[-1].append({"tag": "text", "a": at, "b": at + 1})

    def _follow(self, children: list) -> None:
        """Items behind the headings of one element: up to and with a list, or up to the next h2 to h4."""
        waiting: list[dict] = []
        for c in children:
            heading = "open" in c
            if not heading and waiting:
                self.items.append(c)
            if waiting and (c["tag"] == "list" or c["tag"] in STOP_TAGS):
                for h in waiting:
                    h["items_b"] = len(self.items)
                waiting = []
            if heading:
                c["items_a"] = len(self.items)
                waiting.append(c)
        for h in waiting:
            h["items_b"] = len(self.items)

    def page(self) -> dict:
        self._follow(self.children.pop() or [])
        return {k: getattr(self, k) for k in PAGE.names if k != "error"} | {"error": None}


def scan_html(html: str | None) -> dict | None:
    """The interval index of one page; a page the parser gives up on has an ``error`` and empty lists."""
    if html is None:
        return None
    try:
        return _Index().run(html).page()
    except Exception as e:  # noqa: BLE001 - a broken page gives an error row, never a failed task
        return {k: [] for k in PAGE.names} | {"error": f"{type(e).__name__}: {e}"}


def _arrow(schema: T.StructType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(schema)


@F.arrow_udf(PAGE)
def _scan_udf(html: pa.Array) -> pa.Array:
    kind = _arrow(PAGE)
    parts = [pa.array([scan_html(h) for h in html.slice(lo, PAGES_AT_ONCE).to_pylist()], type=kind) for lo in range(0, len(html), PAGES_AT_ONCE)]
    return pa.concat_arrays(parts) if parts else pa.array([], type=kind)


def parse_page(html) -> Column:
    """The interval index of an HTML column (NULL html -> NULL)."""
    return _scan_udf(F.col(html) if isinstance(html, str) else html)


# ---- selectors ------------------------------------------------------------------------------

_COMPOUND = re.compile(r"^([a-z][a-z0-9]*|\*)?((?:[.#][A-Za-z0-9_-]+)*)$")


def compile_selector(selector: str) -> list[tuple]:
    """'div.panel-box table' -> [(tag, classes, id), ...]; compounds of a tag, classes and an id, descendants only."""
    out = []
    for part in selector.split():
        m = _COMPOUND.match(part)
        if not m:
            raise ValueError(f"selector {selector!r}: only tags, .classes, #ids and spaces between them are known")
        marks = re.findall(r"[.#][A-Za-z0-9_-]+", m[2])
        ids = [x[1:] for x in marks if x[0] == "#"]
        out.append((None if m[1] in (None, "", "*") else m[1], frozenset(x[1:] for x in marks if x[0] == "."), ids[0] if ids else None))
    return out


class _Select(_Events):
    """Per open element and selector, how many of its compounds the ancestors have matched: one step an element."""

    def __init__(self, selectors: list[list[tuple]]):
        super().__init__()
        self.selectors = selectors
        self.hits: list[list[dict]] = [[] for _ in selectors]
        self.reached: list[tuple[int, ...]] = [(0,) * len(selectors)]

    def _step(self, reached: tuple, tag: str, classes: set, ident: str | None, hit) -> tuple:
        new = list(reached)
        for i, (sel, k) in enumerate(zip(self.selectors, reached)):
            want, cls, idn = sel[k]
            if (want is None or want == tag) and cls <= classes and (idn is None or idn == ident):
                if k + 1 == len(sel):
                    hit(i)
                else:
                    new[i] = k + 1
        return tuple(new)

    def opened(self, tag, attrs, number):
        at = {k: v or "" for k, v in attrs}
        reached = self.reached[-1]
        if tag == "tr" and self.stack and self.stack[-1][0] == "table":      # a tbody that was left out
            reached = self._step(reached, "tbody", set(), None, lambda i: None)
        own = []

        def hit(i):
            self.hits[i].append({"open": number, "a": len(self.strings)})
            own.append(self.hits[i][-1])

        self.reached.append(self._step(reached, tag, set(at.get("class", "").split()), at.get("id"), hit))
        return own

    def closed(self, tag, own):
        self.reached.pop()
        for h in own:
            h.update(close=self.n, b=len(self.strings))


def select_ranges(html, selectors: list[str]) -> Column:
    """Elements that match each descendant selector, in document order, as ranges of the page's visible strings."""
    compiled = [compile_selector(s) for s in selectors]

    @F.arrow_udf(SELECTED)
    def run(pages: pa.Array) -> pa.Array:
        out = []
        for h in pages.to_pylist():
            s = None if h is None else _Select(compiled).run(h)
            out.append(s and {"strings": s.strings, "hits": s.hits})
        return pa.array(out, type=_arrow(SELECTED))

    return run(F.col(html) if isinstance(html, str) else html)


# ---- native views of the index --------------------------------------------------------------

def cut(values: Column, a: Column, b: Column) -> Column:
    return F.slice(values, a + 1, b - a)


def joined_text(strings: Column) -> Column:
    """Stripped strings joined by one space, white space collapsed."""
    return collapse_ws(F.array_join(F.filter(F.transform(strings, ustrip), lambda s: s != ""), " "))


def flat_text(strings: Column) -> Column:
    """All strings concatenated, white space collapsed."""
    return collapse_ws(F.array_join(strings, ""))


def tight_text(strings: Column) -> Column:
    """Stripped strings concatenated without a separator."""
    return F.array_join(F.transform(strings, ustrip), "")


_VARIANTS = {"text": joined_text, "flat": flat_text, "tight": tight_text}


def tables_of(page: Column, *what: str, groups: bool = True) -> Column:
    """array<struct<pos, rows: array<struct<group, group_no, cells: array<struct<tag, ...>>>>>> of a parsed page.

    ``what``: the cell fields wanted, of text, flat, tight and badges.  A row's group is the outermost thead, tbody or
    tfoot of its table that holds it, with that group's number among those of the same tag; '' and 0 without one.
    ``groups=False`` leaves both out.
    """
    def cell(c):
        own = cut(page["strings"], c["a"], c["b"])
        out = [c["tag"].alias("tag")] + [f(own).alias(k) for k, f in _VARIANTS.items() if k in what]
        if "badges" in what:
            out.append(F.transform(cut(page["badges"], c["badges_a"], c["badges_b"]),
                                   lambda b: joined_text(cut(page["strings"], b["a"], b["b"]))).alias("badges"))
        return F.struct(*out)

    def row(r, inside):
        cells = F.transform(cut(page["cells"], r["cells_a"], r["cells_b"]), cell).alias("cells")
        if not groups:
            return F.struct(cells)
        mine = F.try_element_at(F.filter(inside, lambda g: (g["open"] < r["open"]) & (r["open"] < g["close"])), F.lit(1))
        # a group's number is counted once a row, not for each of its parts
        number = bind(mine, lambda m: F.when(m.isNull(), 0).otherwise(F.size(F.filter(inside, lambda g: (g["tag"] == m["tag"]) & (g["open"] < m["open"])))))
        return F.struct(F.coalesce(mine["tag"], F.lit("")).alias("group"), number.alias("group_no"), cells)

    def rows(t):
        inside = cut(page["groups"], t["groups_a"], t["groups_b"])
        return F.transform(cut(page["rows"], t["rows_a"], t["rows_b"]), lambda r: row(r, inside))

    return F.transform(page["tables"], lambda t: F.struct(t["open"].alias("pos"), rows(t).alias("rows")))


def heading_text(page: Column, h: Column, flat: bool = False) -> Column:
    return (flat_text if flat else joined_text)(cut(page["strings"], h["a"], h["b"]))


def followers(page: Column, h: Column) -> Column:
    """array<struct<kind, text>> behind a heading: text nodes, paragraphs and the items of the first list."""
    def one(kind, x):
        return F.struct(F.lit(kind).alias("kind"), flat_text(cut(page["strings"], x["a"], x["b"])).alias("text"))

    found = F.flatten(F.transform(cut(page["items"], h["items_a"], h["items_b"]), lambda i: F.when(
        i["tag"] == "list", F.transform(cut(page["lis"], i["a"], i["b"]), lambda x: one("li", x)))
        .otherwise(F.array(F.struct(i["tag"].alias("kind"), flat_text(cut(page["strings"], i["a"], i["b"])).alias("text"))))))
    return F.filter(found, lambda f: (f["kind"] != "text") | (f["text"] != ""))
