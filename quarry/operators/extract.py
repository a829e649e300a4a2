"""Per-section field extraction: pages -> raw (all-string) section tables.

Regex fields read the visible text (X1, native).  Table/list/heading logic
reads the X2 struct with array higher-order functions, so every page is
processed inside one row: no explode, no shuffle, linear in the page count.
Pages are parsed by the Python UDF only where a structural read is needed
(e.g. financial pages whose text matched nothing).
"""

from __future__ import annotations

import json
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.clean import bind, collapse_ws
from ..functions.text import canonical_of, html_text, norm_collapsed
from ..session import cut_lineage
from .html import followers, heading_text, parse_page, tables_of

# ---- fixed values: financial labels and what follows each (case-insensitive, first match, group 1) ----
# The margin and debt-to-equity classes accept the closing parenthesis of '(%)' / '(x)'.
FINANCIAL_FIELDS: dict[str, tuple[str, str]] = {
    "assets": (r"(?:Total\s+)?Assets?", r"\s*[:\s]+₹?\s*([\d,.]+)"),
    "net_worth": (r"Net\s+Worth", r"\s*[:\s]+₹?\s*([\d,.]+)"),
    "total_debt": (r"Total\s+Debt", r"\s*[:\s]+₹?\s*([\d,.]+)"),
    "revenue": (r"(?:Total\s+)?Revenue", r"\s*[:\s]+₹?\s*([\d,.]+)"),
    "ebitda": (r"EBITDA", r"\s*[:\s]+₹?\s*([\d,.]+)"),
    "pat": (r"PAT", r"\s*[:\s]+₹?\s*([\d,.]+)"),
    "ebitda_margin": (r"EBITDA\s+margin", r"\s*[:\s(%)]+\s*([\d.]+)"),
    "pat_margin": (r"PAT\s+margin", r"\s*[:\s(%)]+\s*([\d.]+)"),
    "eps": (r"EPS", r"\s*\(₹\)\s*([+-]?[\d.]+)"),
    "roe": (r"ROE", r"\s*\(%\)\s*([+-]?[\d.]+)"),
    "roce": (r"ROCE", r"\s*\(%\)\s*([+-]?[\d.]+)"),
    "roa": (r"ROA", r"\s*\(%\)\s*([+-]?[\d.]+)"),
    "debt_to_equity": (r"Debt\s+to\s+Equity", r"\s*[:\s(x)]+\s*([\d.]+)"),
    "market_capitalisation": (r"Market\s+Capitalisation?", r"\s*[:\s]+₹?\s*([\d,.]+)"),
    "ev_ebitda": (r"EV\s*/\s*EBITDA", r"\s*\(?times\)?\s*[:\s]+([+-]?[\d.]+)"),
    "pb_multiple": (r"P\s*/\s*B", r"\s*\(?times\)?\s*[:\s]+([+-]?[\d.]+)"),
    "nav": (r"NAV", r"\s*\(₹\)\s*[:\s]+([+-]?[\d.]+)"),
    "enterprise_value": (r"Enterprise\s+Value", r"\s*\(EV\)\s*\(₹\s*Cr\.\)\s*:\s*([\d,.]+)"),
    "pe_multiple": (r"PE\s+Multiple", r"\s*\(times\)\s*:\s*([\d.]+)"),
}
# ---- fixed values: labels of other figures that end in one of the labels above --------------
OTHER_LABELS = [r"(?:Net|Current|Fixed|Other|Intangible|Non-current)\s+Assets?", r"(?:Other|Segment)\s+Revenue", r"Net\s+Debt\s+to\s+EBITDA",
                r"(?:Cash|Adjusted|Adj\.)\s+(?:EBITDA|PAT|EPS)", r"Debt\s*/\s*EBITDA", r"(?:Tangible|Average)\s+Net\s+Worth"]

# ---- fixed values: performance field patterns (case-insensitive) ----------------------------
PERFORMANCE_PATTERNS: dict[str, str] = {
    "face_value": r"Face\s*(?:Value|value)[:\s]+₹?\s*([\d.]+)",
    "issue_price": r"Issue\s*(?:Price|price)[:\s]+₹?\s*([\d.]+)",
    "listing_price": r"Listing\s*(?:Price|price)[:\s]+₹?\s*([\d.]+)",
    "listing_gain": r"Listing\s*(?:Gain|gain)\s*\([^)]*\)\s*([+-]?[\d.]+)\s*(%)?",
}

# ---- fixed values: information field patterns (case-sensitive, lazy up to the next label) ---
INFORMATION_PATTERNS: dict[str, str] = {
    "ipo_category": r"IPO\s+Category\s*:\s*([^:\n]+?)(?:\s+(?:Exchange|Issue|IPO\s+Size)|$)",
    "exchange": r"Exchange\s*:\s*([^:\n]+?)(?:\s+(?:Issue\s+Type|IPO\s+Size)|$)",
    "issue_type": r"Issue\s+Type\s*:\s*([^:\n]+?)(?:\s+(?:IPO\s+Size|Issue\s+Price)|$)",
    "issue_price": r"Issue\s+Price\s*:\s*([^:\n]+?)(?:\s+(?:Market\s+Capitalisation|PE\s+multiple)|$)",
    "pe_multiple": r"PE\s+multiple\s*:\s*([^:\n]+?)(?:\s+(?:Subscription|Pre\s+Issue)|$)",
    "subscription": r"Subscription\s*:\s*([^:\n]+?)(?:\s+(?:Pre\s+Issue|Post\s+Issue|times)|$)",
    "pre_issue_promoter_holding": r"Pre\s+Issue\s+Promoter\s+Holding\s*:\s*([^:\n]+?)(?:\s+(?:Post\s+Issue|%)|$)",
    "post_issue_promoter_holding": r"Post\s+Issue\s+Promoter\s+Holding\s*:\s*([^:\n%]+?)(?:%|$)",
}
INFORMATION_TRAILER = r"(?:Read|Financial|Information|Documents|Key|Highlights).*$"

# ---- fixed values: information date patterns; listing date is case-insensitive --------------
DATE_PATTERNS: dict[str, str] = {
    "dhrp_date": r"Date\s+of\s+DRHP\s*:\s*([^:\n]+?)(?:\s+(?:IPO\s+Open|Initiation)|$)",
    "open_date": r"IPO\s+Open\s+Date\s*:\s*([^:\n]+?)(?:\s+(?:IPO\s+Close|Initiation)|$)",
    "close_date": r"IPO\s+Close\s+Date\s*:\s*([^:\n]+?)(?:\s+(?:IPO\s+Allotment|Initiation)|$)",
    "allotment_date": r"IPO\s+Allotment\s+Date\s*:\s*([^:\n]+?)(?:\s+(?:IPO\s+Listing|Initiation|Refund)|$)",
    "listing_date": r"(?i)IPO\s+Listing\s+Date\s*:\s*(?:<[^>]*>\s*)*(\d{1,2}(?:st|nd|rd|th)?\s+[A-Za-z]{3,9}\s+\d{4})",
}
DATE_TRAILER = r"(?:Initiation|Refund|Read|Documents|Financial).*$"

# ---- fixed values: GMP event labels in priority order -> output field ----------------------
GMP_EVENTS: list[tuple[str, str]] = [("ipo_open_gmp", "Open"), ("ipo_close_gmp", "Close"),
                                     ("ipo_allotment_gmp", "Allotment"), ("ipo_listing_gmp", "Listing")]

# ---- fixed values: category rows skipped per table kind -------------------------------------
SUBSCRIPTION_SKIP = ["total", "total subscription", "total ipo subscription"]
ALLOCATION_SKIP = ["total", "total allocation"]

_PAIRS = "array<struct<key:string,value:string>>"

SECTIONS = ["financials", "gmp", "ipo_information", "performance_report", "subscription"]


def _page_column(pages: DataFrame, html: str) -> Column:
    """The parsed page: the ``_page`` column where a caller has scanned the pages already."""
    return F.col("_page") if "_page" in pages.columns else parse_page(html)


def _field_is(name: str, value: str):
    """Predicate for array HOFs (a closure, not a default argument: Spark reads a
    second lambda parameter as the element index)."""
    return lambda x: x[name] == F.lit(value)


def _matches(pattern: str):
    return lambda x: x.rlike(pattern)


def _field(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


# ---------------------------------------------------------------------------------------------
# X3-X5 financials
# ---------------------------------------------------------------------------------------------
def _label_key(label: Column) -> Column:
    """X4 key of a table label: the first key (longest first) whose spaced name it contains."""
    keys = sorted(FINANCIAL_FIELDS, key=lambda k: (-len(k), list(FINANCIAL_FIELDS).index(k)))
    e = None
    for k in keys:
        cond = label.contains(k.replace("_", " "))
        e = F.when(cond, F.lit(k)) if e is None else e.when(cond, F.lit(k))
    return e


def label_table_pairs(tables: Column) -> Column:
    """(key, value) for every label/value row of every table, in document order."""
    return F.flatten(F.transform(tables, lambda t: F.transform(
        F.filter(t["rows"], lambda r: F.size(r["cells"]) >= 2),
        lambda r: F.struct(bind(F.lower(r["cells"][0]["tight"]), _label_key).alias("key"),
                           r["cells"][1]["tight"].alias("value")))))


def label_table_fields(pairs: Column) -> dict[str, Column]:
    """Per key the last row wins (``pairs`` should be a staged column)."""
    return {k: F.try_element_at(F.filter(pairs, _field_is("key", k)), F.lit(-1))["value"]
            for k in FINANCIAL_FIELDS}


def _alternatives(rx: str) -> list[str]:
    """A label pattern without its leading group: one pattern for each way it begins."""
    m = re.match(r"\(\?:([^)]*)\)(\?)?", rx)
    return [rx] if m is None else [x + rx[m.end():] for x in m[1].split("|") + [""] * bool(m[2])]


def _by_letter(patterns: list[str]) -> str:
    """One pattern for all of them, longer ones first; those that begin with the same letter are tried at that letter only."""
    ways = [w for p in sorted(patterns, key=lambda p: (-len(p), p)) for w in _alternatives(p)]
    return "|".join(f"{a}(?:{'|'.join(w[1:] for w in ways if w[0].lower() == a)})" for a in dict.fromkeys(w[0].lower() for w in ways))


_ALL_LABELS = OTHER_LABELS + [lb for lb, _ in FINANCIAL_FIELDS.values()]
# a label starts where no word, slash or hyphen stands before it; longer labels are tried first
LABEL_RX = rf"(?iu)(?<![\p{{L}}\p{{N}}_/&-])(?:{_by_letter(_ALL_LABELS)})(?![\p{{L}}\p{{N}}_])"
_OPEN, _SHUT = "\ufdd0", "\ufdd1"      # noncharacters, put around labels


def label_pieces(text: Column) -> Column:
    """The text cut once at all labels: array<struct<label, rest>>, ``rest`` up to the next label."""
    def apart(s):
        return bind(F.regexp_extract_all(s, F.lit(LABEL_RX), F.lit(0)), lambda found: F.zip_with(
            found, F.slice(F.split(s, LABEL_RX, -1), F.lit(2), F.greatest(F.size(found), F.lit(0))),
            lambda a, b: F.struct(a.alias("label"), b.alias("rest"))))

    def marked(s):
        pieces = bind(F.split(F.regexp_replace(s, LABEL_RX, f"{_OPEN}$0{_SHUT}"), _OPEN, -1), lambda p: F.slice(p, F.lit(2), F.size(p)))
        return F.transform(pieces, lambda p: bind(F.split(p, _SHUT, -1), lambda x: F.struct(x[0].alias("label"), x[1].alias("rest"))))

    # one search for labels; two in a text that holds the marks itself
    return bind(text, lambda s: F.when(s.contains(_OPEN) | s.contains(_SHUT), apart(s)).otherwise(marked(s))).alias("pieces")


def _spellings(rx: str) -> list[str]:
    """What a label pattern matches, in lower case and without white space."""
    out = [""]
    for optional, plain in re.findall(r"(\(\?:[^)]*\)\?|.\?)|(.)", re.sub(r"\\s[+*]", "", rx)):
        bit = optional.removeprefix("(?:").removesuffix("?").removesuffix(")") if optional else plain
        out = [x + bit for x in out] + (out if optional else [])
    return [x.lower() for x in out]


_FIELD_OF_LABEL = {x: k for k, (label, _) in reversed(FINANCIAL_FIELDS.items()) for x in _spellings(label)}


def _field_of(label: Column) -> Column:
    """The field a label names: by a look-up of its letters, by the patterns where it has other than plain ones."""
    by_rx = None
    for k, (rx, _) in FINANCIAL_FIELDS.items():
        hit = label.rlike(rf"(?iu)^{rx}$")
        by_rx = F.when(hit, F.lit(k)) if by_rx is None else by_rx.when(hit, F.lit(k))
    known = F.from_json(F.lit(json.dumps(_FIELD_OF_LABEL)), "map<string,string>")
    return F.when(label.rlike(r"[^\x00-\x7f]"), by_rx).otherwise(F.try_element_at(known, F.lower(F.translate(label, " \t\n\x0b\f\r", ""))))


def label_fields(pieces: Column) -> dict[str, Column]:
    """Per field the value behind the first of its labels that has one (``pieces``: ``labelled_pieces``, a staged column)."""
    out = {}
    for key, (_, value) in FINANCIAL_FIELDS.items():
        values = F.transform(F.filter(pieces, _field_is("field", key)), _value_of("(?iu)^" + value))
        out[key] = F.try_element_at(F.filter(values, lambda v: v != ""), F.lit(1))
    return out


def labelled_pieces(text: Column) -> Column:
    """The pieces of the text whose label names a field: array<struct<field, rest>>."""
    named = F.transform(label_pieces(text), lambda p: F.struct(bind(p["label"], _field_of).alias("field"), p["rest"].alias("rest")))
    return F.filter(named, lambda p: p["field"].isNotNull())


def _value_of(rx: str):
    return lambda p: F.regexp_extract(p["rest"], rx, 1)


def extract_financials(pages: DataFrame, key: str = "company", html: str = "html") -> DataFrame:
    """X3 + X5: fields behind labels of the visible text; a page where none was found takes the label/value table
    read (X4) instead, and only such pages are parsed.

    One pass per page: each step is staged as a column, the choice is a per-row CASE (a filter/union split would
    read the pages twice).
    """
    page = F.col("_page") if "_page" in pages.columns else None
    s1 = pages.select(key, html, *([page] if page is not None else []), labelled_pieces(html_text(html)).alias("_pieces"))
    s2 = s1.select(key, html, *([page] if page is not None else []),
                   F.struct(*[v.alias(k) for k, v in label_fields(F.col("_pieces")).items()]).alias("_rx"))
    none_hit = F.coalesce(*[F.col("_rx")[k] for k in FINANCIAL_FIELDS]).isNull()
    s3 = s2.select(key, "_rx", (F.when(none_hit, page) if page is not None else parse_page(F.when(none_hit, F.col(html)))).alias("_page"))
    s4 = s3.select(key, "_rx", label_table_pairs(tables_of(F.col("_page"), "tight", groups=False)).alias("_pairs"))
    s5 = s4.select(key, "_rx", F.struct(*[v.alias(k) for k, v in label_table_fields(F.col("_pairs")).items()]).alias("_tb"))
    return s5.select(key, *[F.coalesce(F.col("_rx")[k], F.col("_tb")[k]).alias(k) for k in FINANCIAL_FIELDS])


# ---------------------------------------------------------------------------------------------
# X6 performance, X7-X10 information
# ---------------------------------------------------------------------------------------------
def extract_performance(pages: DataFrame, key: str = "company", html: str = "html") -> DataFrame:
    staged = pages.select(key, html_text(html).alias("_text"))
    return staged.select(key, *[_field(F.col("_text"), "(?iu)" + p).alias(k) for k, p in PERFORMANCE_PATTERNS.items()])


def _trimmed(group: Column, trailer: str) -> Column:
    """A captured group, whitespace-collapsed, trailing section words cut; NULL if it is empty.

    Every capture group here needs at least one character, so an empty group means "no match".
    """
    return bind(group, lambda g: F.when(
        g != "", F.trim(F.regexp_replace(collapse_ws(g), trailer, ""))).otherwise(F.lit(None).cast("string")))


# 'label : value' patterns, none of whose parts but the colon between them can hold a colon: (field, label, value)
_LABELLED = [(k, *p.split(r"\s*:", 1)) for k, p in {**INFORMATION_PATTERNS, **DATE_PATTERNS}.items() if "<" not in p]


def colon_pieces(text: Column) -> Column:
    """The text behind each known label and colon, up to and with the next colon: array<struct<field, rest>>.

    ``text``: visible text, whose white space is single spaces.
    """
    def field(piece):
        e = None
        for k, label, _ in _LABELLED:
            spelled = label.replace(r"\s+", " ")
            hit = piece.endswith(spelled + ":") | piece.endswith(spelled + " :")
            e = F.when(hit, F.lit(k)) if e is None else e.when(hit, F.lit(k))
        return e

    found = bind(F.split(text, "(?<=:)", -1), lambda ps: F.zip_with(F.transform(ps, field), F.slice(ps, F.lit(2), F.size(ps)), lambda f, r: F.struct(f.alias("field"), r.alias("rest"))))
    return F.filter(found, lambda p: p["field"].isNotNull() & p["rest"].isNotNull())


def colon_field(pieces: Column, key: str, value: str) -> Column:
    """The first value behind the field's label, '' for none: what a search of the whole text for label and value finds first."""
    values = F.transform(F.filter(pieces, _field_is("field", key)), _value_of("^" + value))
    return F.coalesce(F.try_element_at(F.filter(values, lambda v: v != ""), F.lit(1)), F.lit(""))


def objects_of_issue(page: Column) -> Column:
    """All items after the first 'object ... issue' heading that has any."""
    def keep(f):
        t = f["text"]
        return (((f["kind"] == "text") & (F.length(t) > 10) & ~t.startswith("<"))
                | ((f["kind"] == "p") & (F.length(t) > 10))
                | ((f["kind"] == "li") & (F.length(t) > 5)))

    def named(h):
        return bind(F.lower(heading_text(page, h, flat=True)), lambda t: t.contains("object") & t.contains("issue"))

    cands = F.transform(F.filter(page["headings"], named),
                        lambda h: F.transform(F.filter(followers(page, h), keep), lambda f: f["text"]))
    return F.try_element_at(F.filter(cands, lambda a: F.size(a) > 0), F.lit(1))


def extract_information(pages: DataFrame, key: str = "company", html: str = "html",
                        with_objects: bool = True) -> DataFrame:
    """X7 + X8 merged (X9, dates win on clashes) + X10 objects."""
    page = ["_page"] if with_objects else []
    given = [_page_column(pages, html).alias("_page")] if with_objects else []
    staged = pages.select(key, *given, html_text(html).alias("_text")).select(key, *page, "_text", colon_pieces(F.col("_text")).alias("_pieces"))
    groups = {k: colon_field(F.col("_pieces"), k, value) for k, _, value in _LABELLED}
    groups |= {k: F.regexp_extract("_text", p, 1) for k, p in DATE_PATTERNS.items() if k not in groups}
    out = staged.select(key, *[_trimmed(groups[k], DATE_TRAILER if k in DATE_PATTERNS else INFORMATION_TRAILER).alias(k)
                               for k in [*INFORMATION_PATTERNS, *DATE_PATTERNS]], *page)
    if with_objects:
        out = out.withColumn("object_of_issue", objects_of_issue(F.col("_page"))).drop("_page")
    return out


# ---------------------------------------------------------------------------------------------
# X11-X15 GMP
# ---------------------------------------------------------------------------------------------
def _first(arr: Column, pred) -> Column:
    return F.try_element_at(F.filter(arr, pred), F.lit(1))


def _norm(s: Column) -> Column:
    return F.lower(collapse_ws(s))


def gmp_table(page: Column, tables: Column) -> Column:
    """X11: first table after an h2/h3 mentioning 'gmp' and 'trend'; else by thead headers."""
    def named(h):
        return bind(F.lower(heading_text(page, h)), lambda t: t.contains("gmp") & t.contains("trend"))

    head = _first(F.filter(page["headings"], lambda h: h["tag"].isin("h2", "h3")), named)
    by_heading = bind(head["open"], lambda open_: _first(tables, lambda t: t["pos"] > open_))

    def thead_headers(t):
        r = _first(t["rows"], lambda r: (r["group"] == "thead") & (r["group_no"] == 0))
        return F.transform(r["cells"], lambda c: _norm(c["text"]))

    by_header = _first(tables, lambda t: F.coalesce(bind(
        thead_headers(t), lambda hs: F.array_contains(hs, "gmp date") & F.array_contains(hs, "gmp")), F.lit(False)))
    return F.coalesce(by_heading, by_header)


def _gmp_label(badges: Column, date_text: Column) -> Column:
    """Badge words first (in priority order), then the date-cell text."""
    e = None
    for _, lbl in GMP_EVENTS:
        c = F.exists(badges, _matches(rf"(?i)\b{lbl}\b"))
        e = F.when(c, F.lit(lbl)) if e is None else e.when(c, F.lit(lbl))
    for _, lbl in GMP_EVENTS:
        e = e.when(date_text.rlike(rf"(?i)\b{lbl}\b"), F.lit(lbl))
    return e


def extract_gmp(pages: DataFrame, key: str = "company", html: str = "html") -> DataFrame:
    """Locate the table, resolve columns by header, tag rows; first row per event wins.

    Staged as consecutive projections so each intermediate is computed once per row.
    """
    t = (pages.select(key, _page_column(pages, html).alias("_page"))
         .select(key, "_page", tables_of(F.col("_page"), "text", "badges").alias("_tables"))
         .select(key, gmp_table(F.col("_page"), F.col("_tables")).alias("_t")))
    rows = F.col("_t.rows")
    hdr = F.coalesce(_first(rows, lambda r: (r["group"] == "thead") & (r["group_no"] == 0)),
                     F.try_element_at(rows, F.lit(1)))
    t = t.select(key, rows.alias("_rows"), F.transform(hdr["cells"], lambda c: _norm(c["text"])).alias("_h"))
    date_i = F.coalesce(F.nullif(F.array_position("_h", "gmp date"), F.lit(0)) - 1, F.lit(0)).cast("int")
    gmp_i = F.coalesce(F.nullif(F.array_position("_h", "gmp"), F.lit(0)) - 1, F.lit(2)).cast("int")
    has_tbody = F.exists("_rows", lambda r: r["group"] == "tbody")
    body = F.when(has_tbody, F.filter("_rows", lambda r: (r["group"] == "tbody") & (r["group_no"] == 0))) \
        .otherwise(F.slice("_rows", F.lit(2), F.greatest(F.size("_rows"), F.lit(0))))
    t = t.select(key, body.alias("_body"), date_i.alias("_di"), gmp_i.alias("_gi"))

    def cells(r):
        return bind(F.filter(r["cells"], lambda c: c["tag"] == "td"), lambda tds: F.when(
            F.size(tds) > F.greatest(F.col("_di"), F.col("_gi")),
            F.struct(F.try_element_at(tds, F.col("_di") + 1).alias("d"), F.try_element_at(tds, F.col("_gi") + 1).alias("g"))))

    def event(x):
        gmp_text = F.regexp_replace(collapse_ws(x["g"]["text"]), r"(\d),(?=\d)", "$1")
        value = bind(F.regexp_extract(gmp_text, r"([+-]?\d+(?:\.\d+)?)", 1), lambda v: F.nullif(v, F.lit("")))
        lbl = bind(F.transform(x["d"]["badges"], collapse_ws), lambda badges: bind(
            collapse_ws(x["d"]["text"]), lambda date_text: _gmp_label(badges, date_text)))
        return F.struct(lbl.alias("label"), value.alias("value"))

    pairs = F.transform(F.filter(F.transform("_body", cells), lambda x: x.isNotNull()), event)
    ev = F.filter(pairs, lambda e: e["value"].isNotNull() & e["label"].isNotNull())
    t = t.select(key, ev.alias("_ev"))
    return t.select(key, *[F.try_element_at(F.filter("_ev", _field_is("label", lbl)), F.lit(1))["value"].alias(f)
                           for f, lbl in GMP_EVENTS])


# ---------------------------------------------------------------------------------------------
# X16-X23 subscription / allocation
# ---------------------------------------------------------------------------------------------
def _header_row(t: Column) -> Column:
    """The first row that looks like a header -> struct<idx (0-based), headers>."""
    cand = F.transform(t["rows"],
                       lambda r, i: F.struct(i.alias("idx"), F.transform(r["cells"], lambda c: c["flat"]).alias("headers")))

    def looks(h):
        joined = F.lower(F.array_join(h["headers"], " | "))
        return bind(joined, lambda j: (j.contains("category") & (F.size(h["headers"]) >= 2))
                    | j.contains("subscription") | j.contains("size") | j.contains("%"))

    return _first(cand, looks)


def _index_of(arr: Column, pred) -> Column:
    """0-based index of the first element satisfying ``pred``; NULL when none."""
    return _first(F.transform(arr, lambda x, i: F.when(pred(x), i)), lambda i: i.isNotNull())


def header_tables(tables: Column) -> Column:
    """X16 for every table once: array<struct<rows, header: struct<idx, headers>>> (shared by X17 and X18)."""
    return F.transform(tables, lambda t: F.struct(t["rows"].alias("rows"), bind(_header_row(t), lambda h: F.when(h.isNotNull(), F.struct(
        h["idx"].alias("idx"), F.transform(h["headers"], F.lower).alias("headers")))).alias("header")))


def _pairs_after_header(table: Column, y: Column, prefix: str, skip: list[str]) -> Column:
    def pair(r):
        cells = r["cells"]
        # a cell's text has its whitespace collapsed already
        cat = norm_collapsed(F.try_element_at(cells, (y["ci"] + 1).cast("int"))["flat"])
        val = F.try_element_at(cells, (y["vi"] + 1).cast("int"))["flat"]
        made = bind(F.struct(cat.alias("cat"), val.alias("val")), lambda p: F.when(
            (p["cat"] != "") & ~F.lower(p["cat"]).isin(skip) & (p["val"] != ""),
            F.struct(F.concat(F.lit(prefix), canonical_of(norm_collapsed(p["cat"]))).alias("key"), p["val"].alias("value"))))
        return F.when(F.size(cells) > F.greatest(y["ci"], y["vi"]), made)

    rows = F.slice(table["rows"], (table["header"]["idx"] + 2).cast("int"), F.size(table["rows"]))
    out = F.filter(F.transform(rows, pair), lambda p: p.isNotNull())
    return F.when(y["ci"].isNotNull() & y["vi"].isNotNull(), out)


def _category_pairs(tables: Column, prefix: str, value_pred, skip: list[str]) -> Column:
    """Per table: rows after the header -> (prefix + canonical category, value); first non-empty table wins."""
    def pairs(x):
        headers = x["header"]["headers"]
        where = F.struct(_index_of(headers, lambda h: h.contains("category")).alias("ci"), _index_of(headers, value_pred).alias("vi"))
        return bind(where, lambda y: _pairs_after_header(x, y, prefix, skip))

    per_table = F.transform(tables, pairs)
    return F.coalesce(_first(per_table, lambda a: F.size(a) > 0), F.array().cast(_PAIRS))


def _last_wins_map(pairs: Column) -> Column:
    """Pairs -> map, the last pair per key winning: one look-up per distinct key from the end."""
    keys = F.transform(pairs, lambda p: p["key"])
    last = F.transform(F.array_distinct(keys), lambda k: F.struct(k.alias("key"), F.element_at(F.filter(pairs, lambda p: p["key"] == k), -1)["value"].alias("value")))
    return F.map_from_entries(last)


def subscription_pairs(tables: Column) -> Column:
    """Category -> subscription times (headers 'category' and 'subscription ... time')."""
    return _category_pairs(tables, "subscription_", lambda h: h.contains("subscription") & h.contains("time"),
                           SUBSCRIPTION_SKIP)


def allocation_pairs(tables: Column) -> Column:
    """Category -> allocation %, header '%' with size/allocation/issue."""
    return _category_pairs(
        tables, "allocation_",
        lambda h: h.contains("%") & (h.contains("size") | h.contains("allocation") | h.contains("issue")),
        ALLOCATION_SKIP)


def extract_subscription(pages: DataFrame, key: str = "company", html: str = "html") -> DataFrame:
    """One dynamic record per page as ``map<string,string>`` (keys disjoint by prefix).

    Staged projections: parse -> header facts per table -> pairs -> map, so no
    intermediate array is recomputed inside a lambda.
    """
    t = (pages.select(key, _page_column(pages, html).alias("_page"))
         .select(key, tables_of(F.col("_page"), "flat", groups=False).alias("_tables"))
         .select(key, header_tables(F.col("_tables")).alias("_tabs"))
         .select(key, subscription_pairs(F.col("_tabs")).alias("_sp"), allocation_pairs(F.col("_tabs")).alias("_ap")))
    return t.select(key, F.map_concat(_last_wins_map(F.col("_sp")), _last_wins_map(F.col("_ap"))).alias("fields"))


# ---------------------------------------------------------------------------------------------
# X24 dispatch
# ---------------------------------------------------------------------------------------------
EXTRACTORS = {
    "financials": extract_financials,
    "gmp": extract_gmp,
    "ipo_information": extract_information,
    "performance_report": extract_performance,
    "subscription": extract_subscription,
}


def page_error(html: Column, page: Column) -> Column:
    """Why a page gives no trustworthy record, NULL for a sound one.

    No content; given up by the parser; cut inside a tag or comment; cut before the end of its html element.
    """
    low = F.lower(html)
    return (F.when(html.isNull() | ~html.rlike(r"\S"), F.lit("no content"))
            .when(page["error"].isNotNull(), page["error"])
            .when(html.rlike(r"(?s)<[A-Za-z/!?][^>]*\z"), F.lit("cut inside a tag"))
            .when(low.contains("<html") & ~low.contains("</html"), F.lit("no end of page")))


class Scanned(NamedTuple):
    pages: DataFrame           # sound pages with their scan in ``_page``: input of the extractors
    failures: DataFrame        # the keys and ``error`` of the others
    n_pages: int
    n_failed: int


def scan_pages(pages: DataFrame, keys: list[str], html: str = "html", path: str | None = None, by: str | None = None) -> Scanned:
    """One scan of all pages, written once, that gives sound pages and a quarantine of failed ones.

    The counts are observed by the job that writes.  ``path`` is a Parquet folder; without one the scan is a
    stage in the checkpoint dir, with a folder for each value of ``by``: a reader of one value skips the others.
    """
    counts = Observation()
    s = pages.withColumn("_page", parse_page(html))
    s = s.withColumn("error", page_error(F.col(html), F.col("_page"))).observe(
        counts, F.count(F.lit(1)).alias("n_pages"), F.count("error").alias("n_failed"))
    if path is None:
        s = cut_lineage(s, by)
    else:
        s.write.mode("overwrite").parquet(path)
        s = pages.sparkSession.read.parquet(path)
    return Scanned(s.where(F.col("error").isNull()).drop("error"),
                   s.where(F.col("error").isNotNull()).select(*keys, "error"), counts.get["n_pages"], counts.get["n_failed"])


def unsupported(pages: DataFrame, section: str = "section") -> DataFrame:
    """Pages of sections without an extractor, counted instead of failing the run."""
    return pages.where(~F.col(section).isin(list(EXTRACTORS))).groupBy(section).count()
