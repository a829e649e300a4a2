"""Typed cleaning of scraped text cells: Column -> Column, all native expressions.

Every function is total: malformed input gives NULL, never an error (ANSI mode
is on in Spark 4, so parsing uses ``try_cast`` / ``try_to_date``).
"""

from __future__ import annotations

import calendar
import json
from collections.abc import Callable
from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnFn = Callable[[Column], Column]

# ---- fixed values: cell contents that mean "missing" (exact, case-sensitive, after trim) ----
PLACEHOLDER_TOKENS = ["[●]", "[•]", "—", "-", "NA", "N/A", "null", "None", ""]

# ---- month names: full, first three letters, and the four-letter form of September ----------
MONTHS = {**{calendar.month_name[i].lower(): i for i in range(1, 13)}, **{calendar.month_abbr[i].lower(): i for i in range(1, 13)}, "sept": 9}

_WS = r"(?U)\s"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# every character for which Python's str.isspace() is true (what str.strip() removes)
_PY_SPACES = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


# holds every white space but the plain space (and a few characters more): without one, ends can only have plain spaces
_ODD_SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680-\u200f\u2028-\u205f\u3000"
_ODD_RX = f"[{_ODD_SPACES}]"
# an odd space, or a plain one at an end or before another; begins with one class, as most characters are none of it
_UNCOLLAPSED_RX = rf"[ {_ODD_SPACES}](?:(?<! )|(?<=^ )|(?= |\z))"


def ustrip(x) -> Column:
    """Strip Unicode whitespace at both ends, as Python's ``str.strip()``.

    Most text has plain spaces at its ends at most; the slower ``btrim`` by a set reads only the rest.
    """
    return bind(_c(x), lambda s: F.when(s.rlike(_ODD_RX), F.btrim(s, F.lit(_PY_SPACES))).otherwise(F.trim(s)))


def collapse_ws(x) -> Column:
    """Runs of Unicode whitespace -> one space, then strip; text that needs neither stays as it is."""
    return bind(_c(x), lambda s: F.when(s.rlike(_UNCOLLAPSED_RX), F.btrim(F.regexp_replace(s, r"(?U)\s+", " "), F.lit(_PY_SPACES))).otherwise(s))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def finite_or_null(x: Column) -> Column:
    """NaN and infinities -> NULL (an infinity times zero is NaN; any finite number stays as it is)."""
    return F.nanvl(x + x * F.lit(0.0), F.lit(None).cast("double"))


_NUMBER_RX = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def strict_double(x: Column) -> Column:
    """A plain decimal number -> DOUBLE; other text ('1d', 'inf') and numbers beyond the range -> NULL."""
    return finite_or_null(F.regexp_extract(x, _NUMBER_RX, 0).try_cast("double"))


def missing_to_null(x) -> Column:
    """Strip; placeholder tokens (exact, case-sensitive) and blanks -> NULL."""
    return bind(ustrip(_c(x).cast("string")), lambda s: F.when(~s.isin(PLACEHOLDER_TOKENS), s))


def strip_ordinal(x) -> Column:
    """P2: '31st' -> '31'."""
    return F.regexp_replace(_c(x), r"(?i)(\d+)(st|nd|rd|th)\b", "$1")


def parse_number(x) -> Column:
    """Thousands commas allowed; non-numbers and non-finite values -> NULL."""
    s = missing_to_null(x)
    return strict_double(ustrip(F.replace(s, F.lit(","), F.lit(""))))


def parse_percentage(x) -> Column:
    """P5: optional trailing '%', commas; the value stays in percent units."""
    s = missing_to_null(x)
    s = F.regexp_replace(s, r"(?U)\s*%$", "")
    return strict_double(ustrip(F.replace(s, F.lit(","), F.lit(""))))


def parse_money_crore(x) -> Column:
    """Indian money -> crore.  The unit is read *before* spaces are removed, so
    '₹ 356.19 Cr.' -> 356.19 and '₹ 25.5 Lakh' -> 0.255; no unit -> the number as is."""
    s = F.lower(missing_to_null(x))
    unit = F.regexp_extract(s, r"(crores?|cr\.?|lakhs?|lacs?)(?![a-z])", 1)
    num = F.regexp_replace(s, r"(?U)[₹,\s]|crores?|cr\.?|lakhs?|lacs?", "")
    val = strict_double(num)
    return F.when(unit.startswith("la"), val / F.lit(100.0)).otherwise(val)


# shapes of a date (digit runs '9', letter runs 'a') by the order of its three groups; the second list is optional
DAY_FIRST, YEAR_OR_DAY_FIRST = ["9 a 9"], ["9-9-9", "9/9/9"]
EXTRA_DAY_FIRST, MONTH_FIRST = ["9 a, 9", "9.9.9"], ["a 9 9", "a 9, 9"]


def parse_date(x, extra: bool = True) -> Column:
    """Ordinal-tolerant date in one of several layouts -> DATE; anything else, or no such day -> NULL.

    The text is cut once into three groups; its shape says which is the day, the month and the year, months are looked
    up by name, and one cast checks the result.  Day first: '31 March 2015', '31 Mar 2015', '31/03/2015',
    '31-03-2015'; year first: '2015-03-31'; with ``extra`` also 'March 31, 2015', '31 March, 2015', '31.3.2015',
    '2015/3/31' and a two-digit year after a three-letter month ('31 Mar 15').
    """
    months = F.from_json(F.lit(json.dumps(MONTHS)), "map<string,string>")
    month = lambda m: F.when(m.rlike("[^0-9]"), F.try_element_at(months, F.lower(m))).otherwise(m)
    day_first = DAY_FIRST + YEAR_OR_DAY_FIRST + (EXTRA_DAY_FIRST if extra else [])

    def cut(s):
        shape = F.regexp_replace(F.regexp_replace(s, "[0-9]+", "9"), r"[^9\s,./-]+", "a")
        return F.struct(shape.alias("shape"), F.split(s, "[ ,./-]+").alias("g"))

    def order(p):
        shape, first, second, third = p["shape"], *(F.try_element_at(p["g"], F.lit(i)) for i in (1, 2, 3))
        short = (shape == "9 a 9") & (F.length(third) == 2) & (F.length(second) == 3) if extra else F.lit(False)
        year_first = shape.isin(YEAR_OR_DAY_FIRST if extra else ["9-9-9"]) & (F.length(first) == 4)
        return (F.when(year_first, F.concat_ws("-", first, second, third))
                .when(shape.isin(day_first), F.concat_ws("-", F.when(short, F.concat(F.lit("20"), third)).otherwise(third), month(second), first))
                .when(shape.isin(MONTH_FIRST if extra else []), F.concat_ws("-", third, month(first), second)))

    # nested lambdas: each step is worked out once and no copy of the input's expression enters generated code
    ymd = bind(bind(ustrip(strip_ordinal(missing_to_null(x))), cut), order)
    return F.regexp_extract(ymd, "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", 0).try_cast("date")


def company_slug(x) -> Column:
    """Lower, non [a-z0-9_] runs -> '_', collapse, trim '_'; empty -> NULL."""
    s = F.lower(missing_to_null(x))
    s = F.regexp_replace(s, r"(?U)\s+", "_")
    s = F.regexp_replace(s, r"[^a-z0-9_]+", "_")
    s = F.regexp_replace(s, r"_+", "_")
    s = F.regexp_replace(s, r"^_+|_+$", "")
    return F.nullif(s, F.lit(""))


def parse_text(x) -> Column:
    """P8."""
    return missing_to_null(x)


def parse_listlike_text(x) -> Column:
    """P1 + whitespace collapse."""
    return collapse_ws(missing_to_null(x))


CLEANERS: dict[str, ColumnFn] = {
    "money": parse_money_crore,
    "number": parse_number,
    "percent": parse_percentage,
    "date": parse_date,
    "company": company_slug,
    "text": parse_text,
    "listtext": parse_listlike_text,
}

# ---- fixed values: cleaner kind by exact column name --------------------------------------
CLEANER_BY_NAME: dict[str, str] = {
    "company": "company",
    **{c: "number" for c in [
        "assets", "net_worth", "total_debt", "revenue", "ebitda", "pat", "ebitda_margin", "pat_margin", "eps",
        "roe", "roce", "roa", "debt_to_equity", "market_capitalisation", "enterprise_value", "ev_ebitda",
        "pb_multiple", "pe_multiple", "nav", "ipo_open_gmp", "ipo_close_gmp", "ipo_allotment_gmp",
        "ipo_listing_gmp", "subscription", "face_value", "listing_price", "listing_gain", "current_market_price"]},
    "ipo_category": "text", "exchange": "text", "issue_type": "text",
    "ipo_size": "money", "issue_price": "money",
    # holdings may carry a '%' sign; the percent parser accepts both forms
    "pre_issue_promoter_holding": "percent", "post_issue_promoter_holding": "percent",
    "object_of_issue": "listtext",
}
# ---- fixed values: what a column's name says when it has no entry above ---------------------
NAME_RULES: list[tuple[str, str]] = [("allocation_*", "percent"), ("subscription_*", "number"), ("*_date", "date")]


def cleaner_kind(name: str, overrides: dict[str, str] | None = None) -> str:
    """The override or the entry of a column, else the first rule its name fits, else text."""
    known = {**CLEANER_BY_NAME, **(overrides or {})}
    return known.get(name) or next((kind for rule, kind in NAME_RULES if fnmatchcase(name, rule)), "text")


def clean_df(df: DataFrame, overrides: dict[str, str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Clean every column with its dispatched cleaner (narrow projections, no shuffle).

    The placeholder/strip step is staged in its own projection so that parsers
    which read their input several times (dates try several layouts) reference a
    column instead of repeating the string expression.
    """
    keep = set(keep or [])
    todo = [c for c in df.columns if c not in keep]
    staged = df.select(*[F.col(c) if c in keep else missing_to_null(F.col(c)).alias(c) for c in df.columns])
    return staged.select(*[(F.col(c) if c in keep else CLEANERS[cleaner_kind(c, overrides)](F.col(c)).alias(c))
                           for c in df.columns]) if todo else staged
