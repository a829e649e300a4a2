"""Crawl work-list as table operators (no network access).

The manifest, fan-out, pending set, routing and response classification of a
crawler are all plain DataFrame transforms: a page table plus a fetch log in,
the next work-list out.  Fan-out uses ``inline`` of a literal section array
(bounded by configuration), never a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.url import looks_like_json
from .html import cut, flat_text, select_ranges

# ---- fixed values: columns (data, name) of each segment's list, its list type ---
LIST_COLUMNS: dict[str, list[tuple[str, str]]] = {
    "sme": [
        ("company_link", "company_name"), ("listing_year", "listing_year"), ("city_sme", "company_location"),
        ("sector", "sectors.name"), ("ipo_sizee", "ipo_size"), ("pe Ratio", "price_to_earning"),
        ("exchange", "exchange"), ("merchant_banker", "merchant_banker"),
    ],
    "mainboard": [
        ("company_link", "company_name"), ("ipo_year_mb", "ipo_year"), ("city", "company_location"),
        ("sector", "sectors.name"), ("ipo_sizee", "ipo_size"), ("pe Ratio", "price_to_earning"),
        ("merchant_banker_mainboard", "merchant_banker_mainboard"),
    ],
}
LIST_TYPE = {"sme": "SME", "mainboard": "MainBoard"}
PAGE_SIZE = 10


def list_params(segment: str) -> dict[str, str]:
    """Query parameters of a segment's list API, in request order."""
    params = {"draw": "1"}
    for i, (data, name) in enumerate(LIST_COLUMNS[segment]):
        for field, value in (("[data]", data), ("[name]", name), ("[searchable]", "true"), ("[orderable]", "true"),
                             ("[search][value]", ""), ("[search][regex]", "false")):
            params[f"columns[{i}]{field}"] = value
    return params | {"start": "0", "length": str(PAGE_SIZE), "search[value]": "", "search[regex]": "false",
                     "ipo_type": LIST_TYPE[segment], "_": "0"}


# ---- fixed values: per-section page templates; a keyed section takes its URL from a column --
SECTION_TEMPLATES: list[tuple[str, str | None, str | None]] = [
    ("ipo_information", "{base_url}/ipo/{slug}/{id}", None),
    ("financials", "{base_url}/ipo/financial-report/{slug}/{id}", None),
    ("subscription", "{base_url}/ipo/subscription/{slug}/{id}", None),
    ("peers", "{base_url}/ipo/peer-comparison/{slug}/{id}", None),
    ("performance_report", "{base_url}/ipo/performance-report/{slug}/{id}", None),
    ("review", "{base_url}/ipo/review/{slug}/{id}", None),
    ("gmp", None, "investor_gain"),
]


def _page_query(params: dict[str, str], page: Column, cache_buster_ms: int) -> Column:
    length = int(params.get("length", PAGE_SIZE))
    dyn = {"draw": page.cast("string"), "start": ((page - 1) * length).cast("string"),
           "_": (F.lit(cache_buster_ms).cast("long") + page).cast("string")}
    return F.concat_ws("&", *[F.concat(F.url_encode(F.lit(k)), F.lit("="), F.url_encode(dyn.get(k, F.lit(v))))
                              for k, v in {**params, **{k: "" for k in dyn if k not in params}}.items()])


def page_manifest(counts: DataFrame, n_col: str, api_url: str | dict[str, str], params: dict[str, str] | None = None,
                  cache_buster_ms: int = 0, keys: list[str] | None = None, segment: str | None = None) -> DataFrame:
    """One row per list page 1..n with draw=p, start=(p-1)*length, _=ts+p, URL-encoded query.

    ``n_col`` holds the number of pages per input row (e.g. per segment); the
    cache-buster base is an argument so manifests are reproducible.  With ``segment`` (a column
    of segment names) each row takes the address and parameters of its own segment; an unknown
    segment has no list and gives a NULL url.
    """
    keys = [k for k in (keys or []) if k != n_col]
    named = [segment] if segment and segment not in keys else []
    pages = counts.select(*keys, *named, F.explode(F.sequence(F.lit(1), F.col(n_col).cast("int"))).alias("page"))

    def address(url: str, p: dict[str, str]) -> Column:
        return F.concat(F.lit(url + "?"), _page_query(p, F.col("page"), cache_buster_ms))

    if segment is None:
        url = address(api_url, list_params("sme") if params is None else params)
    else:
        url = F.lit(None).cast("string")
        for name in LIST_COLUMNS:
            own = api_url[name] if isinstance(api_url, dict) else api_url
            url = F.when(F.col(segment) == name, address(own, params or list_params(name))).otherwise(url)
    return pages.select(*keys, "page", url.alias("url"))


def pages_needed(df: DataFrame, group: list[str], page_size: int = 10) -> DataFrame:
    """Pages per group for a listing of ``page_size`` rows per page (input of C1)."""
    return df.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / page_size).cast("int").alias("n_pages"))


def fill_template(template: Column | str, **values: Column) -> Column:
    t = F.lit(template) if isinstance(template, str) else template
    for k, v in values.items():
        t = F.replace(t, F.lit("{" + k + "}"), v.cast("string"))
    return t


def fan_out(base: DataFrame, base_url: str, company: str = "company_name", slug: str = "slug", id_col: str = "id",
            sections: list[tuple[str, str | None, str | None]] | None = None) -> DataFrame:
    """C2 + C6: (company row) x (configured section) -> (section, company key, url).

    Template sections fill ``{base_url}``, ``{slug}``, ``{id}``; keyed sections take
    the URL from a column and are skipped when it is NULL.
    """
    sections = SECTION_TEMPLATES if sections is None else sections
    entries = []
    for name, tpl, key in sections:
        if tpl is not None:
            url = fill_template(tpl, base_url=F.lit(base_url), slug=F.col(slug), id=F.col(id_col))
        else:
            url = F.col(key).cast("string")
        entries.append(F.struct(F.lit(name).alias("section"), url.alias("url")))
    storage_key = F.replace(F.lower(F.col(company)), F.lit(" "), F.lit("_"))
    out = base.select(storage_key.alias("company"), F.inline(F.array(*entries)))
    return out.where(F.col("url").isNotNull())


def pending(frontier: DataFrame, fetched: DataFrame, keys: list[str]) -> DataFrame:
    """Targets not yet fetched (anti join on the storage key)."""
    return frontier.join(fetched.select(*keys).distinct(), on=keys, how="left_anti")


def route(url) -> Column:
    """C4: handler by URL substring."""
    u = F.col(url) if isinstance(url, str) else url
    return F.when(u.contains("/gmp/"), "gmp").when(u.contains("/subscription/"), "subscription").otherwise("generic")


def classify_response(status, body, success_key: str | None = None) -> Column:
    """Success / retry (429, 5xx, 2xx with an error-shaped JSON body) / fail."""
    st = F.col(status) if isinstance(status, str) else status
    b = F.col(body) if isinstance(body, str) else body
    ok = st.between(200, 299)
    is_json = looks_like_json(b)
    has_error = F.get_json_object(b, "$.error").isNotNull() & F.get_json_object(b, "$.msg").isNotNull()
    good = F.get_json_object(b, f"$.{success_key}").isNotNull() if success_key else ~has_error
    success = ok & is_json & good
    retry = (st == 429) | st.between(500, 599) | (ok & has_error)
    return F.when(success, "success").when(retry, "retry").otherwise("fail")


def page_complete(pages: DataFrame, key: str = "company", html: str = "html", table: str = "div.panel-box table",
                  panel: str = "div.panel-box", min_rows: int = 1, placeholder: str = "[●]") -> DataFrame:
    """The first ``table`` element has ``min_rows`` body rows and text in one of them, or the first ``panel``
    element has text without the placeholder.  Text elsewhere on the page (menus, footers) tells nothing."""
    s = pages.select(key, select_ranges(html, [table, f"{table} tbody tr", panel]).alias("_s"))
    strings, hits = F.col("_s.strings"), F.col("_s.hits")
    t, p = F.try_element_at(hits[0], F.lit(1)), F.try_element_at(hits[2], F.lit(1))
    s = s.select(key, "_s", F.filter(hits[1], lambda r: (t["open"] < r["open"]) & (r["open"] < t["close"])).alias("_rows"),
                 flat_text(cut(strings, p["a"], p["b"])).alias("_text"))
    rows_ok = (F.size("_rows") >= min_rows) & F.exists("_rows", lambda r: flat_text(cut(strings, r["a"], r["b"])) != "")
    text_ok = (F.length("_text") > 0) & ~F.contains(F.col("_text"), F.lit(placeholder))
    return s.select(key, (F.coalesce(rows_ok, F.lit(False)) | F.coalesce(text_ok, F.lit(False))).alias("complete"))
