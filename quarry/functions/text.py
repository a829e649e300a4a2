"""Native text helpers for HTML pages and table cells."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import _c, bind, collapse_ws

# what is no text, in the order it is removed; a tag's quoted attribute values may hold any character
_COMMENT = r"(?s)<!--.*?-->"
_HIDDEN = r"(?is)<(script|style|template)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?</\1\s*>"
_TAG = r"(?s)<[/!?]?[A-Za-z](?:[A-Za-z0-9]*+>|(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+>)"
# white space that is not one plain space; these patterns begin with one character or class, as most places match none
_SPACES = r"[ \t\n\x0b\f\r\xa0](?:(?<! )|(?=[ \t\n\x0b\f\r\xa0]))[ \t\n\x0b\f\r\xa0]*+"
_REFERENCE = r"&(#[0-9]{1,8}|#[xX][0-9A-Fa-f]{1,7}|[A-Za-z][A-Za-z0-9]{1,31});"
# named references as the language's standard library lists them; numbers 128 to 159 mean Windows-1252 characters
_NAMED = {k[:-1]: v for k, v in html5.items() if k.endswith(";")}
# by first letter: a look-up in a map compares one key after the other
_NAMED_BY_LETTER = {a: {k: v for k, v in _NAMED.items() if k[0] == a} for a in sorted({k[0] for k in _NAMED})}
_CP1252 = {str(i): bytes([i]).decode("cp1252", "replace") for i in range(128, 160)}


def _character(number: Column) -> Column:
    """The character of a code point; U+FFFD where there is none."""
    ok = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(ok, number).otherwise(0xFFFD)), 8, "0")), "UTF-32")
    windows = F.from_json(F.lit(json.dumps(_CP1252)), "map<string,string>")
    return F.when(number.between(128, 159), F.try_element_at(windows, number.cast("string"))).otherwise(char)


def decode_references(x) -> Column:
    """Character references -> characters: numeric ones by code point, named ones by a look-up; unknown ones stay.

    The text is cut once at all references, so what a reference gives is never read as part of another one.
    """
    named = F.from_json(F.lit(json.dumps(_NAMED_BY_LETTER)), "map<string,map<string,string>>")

    def one(r):
        hexa = F.conv(F.substring(r, 3, 8), 16, 10).cast("int")
        return (F.when(r.startswith("#x") | r.startswith("#X"), _character(hexa))
                .when(r.startswith("#"), _character(F.substring(r, 2, 8).cast("int")))
                .otherwise(F.coalesce(F.try_element_at(F.try_element_at(named, F.substring(r, 1, 1)), r), F.concat(F.lit("&"), r, F.lit(";")))))

    def decoded(s):
        text = F.transform(F.regexp_extract_all(s, F.lit(_REFERENCE), F.lit(1)), one)
        pieces = F.zip_with(F.split(s, _REFERENCE, -1), text, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
        return F.when(s.contains("&"), F.array_join(pieces, "")).otherwise(s)

    return bind(_c(x), decoded)


def html_text(x) -> Column:
    """Visible text of a page, text nodes joined by one space (no script, style, template or comment)."""
    s = bind(_c(x), lambda h: F.when(h.contains("<!--"), F.regexp_replace(h, _COMMENT, " ")).otherwise(h))
    s = F.regexp_replace(F.regexp_replace(s, _HIDDEN, " "), _TAG, " ")
    return F.trim(F.regexp_replace(decode_references(s), _SPACES, " "))


def first_signed_decimal(x) -> Column:
    """X13 (+B16: thousands commas removed first): first signed decimal -> DOUBLE."""
    s = F.regexp_replace(_c(x), r"(\d),(?=\d)", "$1")
    return F.nullif(F.regexp_extract(s, r"([+-]?\d+(?:\.\d+)?)", 1), F.lit("")).try_cast("double")


def slugify(x) -> Column:
    """Lower, '&' -> ' and ', drop '₹', non-alnum runs -> '_', trim '_'."""
    s = F.lower(_c(x))
    s = F.replace(s, F.lit("&"), F.lit(" and "))
    s = F.replace(s, F.lit("₹"), F.lit(""))
    s = F.regexp_replace(s, r"[^a-z0-9]+", "_")
    return F.regexp_replace(s, r"^_+|_+$", "")


def norm_category_text(x) -> Column:
    """Nbsp -> space, drop '*', drop a leading bullet/dash, collapse whitespace."""
    return norm_collapsed(collapse_ws(x))


def norm_collapsed(x) -> Column:
    """X21 for text whose whitespace is collapsed already (no nbsp, no space at its ends)."""
    return bind(x, lambda s: F.when(s.rlike(r"\*|^[-–•]"), collapse_ws(F.regexp_replace(F.regexp_replace(s, r"\*+", ""), r"^\s*[-–•]+", ""))).otherwise(s))


def norm_header(x) -> Column:
    """Whitespace-collapsed, lower-cased header text."""
    return F.lower(collapse_ws(x))


def canonical_category(x) -> Column:
    """Noisy investor-category label -> stable key (ordered rules, first hit wins).

    'QIB (Ex Anchor)' is tested before the anchor rule so it keeps its own key.
    """
    return canonical_of(norm_category_text(x))


def canonical_of(raw: Column) -> Column:
    """X19 for a label that is normalised already."""
    return bind(raw, lambda r: bind(F.lower(r), lambda low: _category_rules(r, low)))


def _category_rules(raw: Column, low: Column) -> Column:
    has = low.contains
    ten_lakh = has("10l") | has("10 l") | has("10lac") | has("10 lakh")
    is_nii = has("non-institutional") | has("non institutional") | low.rlike(r"\bnii\b")
    return (F.when(has("qib") & has("ex") & has("anchor"), F.lit("qib_ex_anchor"))
            .when(has("anchor"), F.lit("anchor_investors"))
            .when(has("qib"), F.lit("qib"))
            .when(has("retail") | has("rii"), slugify(raw))
            .when(is_nii & (has("bnii") | (has("above") & ten_lakh)), slugify(raw))
            .when(is_nii & (has("snii") | (has("below") & ten_lakh)), slugify(raw))
            .when(is_nii, F.lit("non_institutional_buyers"))
            .when(has("employee"), F.lit("employees"))
            .when(has("shareholder"), F.lit("shareholders"))
            .otherwise(slugify(raw)))
