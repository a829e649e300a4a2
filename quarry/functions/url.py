"""URL / response helpers for the crawl work-list (native expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import _c

_PATH_RX = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def url_path(x) -> Column:
    """Path part of an absolute URL, percent-decoded (NULL-safe, no URI parsing errors)."""
    p = F.regexp_extract(_c(x), _PATH_RX, 1)
    return F.coalesce(F.try_url_decode(p), p)


def url_numeric_id(x) -> Column:
    """Last all-digit path segment, else digits at the end of the path, else NULL."""
    path = url_path(x)
    segs = F.filter(F.split(path, "/"), lambda s: s.rlike(r"^\d+$"))
    tail = F.nullif(F.regexp_extract(path, r"(\d+)/?$", 1), F.lit(""))
    return F.coalesce(F.try_element_at(segs, F.lit(-1)), tail)


def storage_key(x) -> Column:
    """Lower-case, spaces -> '_'."""
    return F.replace(F.lower(_c(x)), F.lit(" "), F.lit("_"))


def looks_like_json(x) -> Column:
    """Text starting (after leading whitespace) with '{' or '['."""
    return F.coalesce(_c(x).rlike(r"(?U)^\s*[\[{]"), F.lit(False))
