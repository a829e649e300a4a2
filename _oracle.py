"""DuckDB SQL builders for the correctness oracle (test-side only).

These build plain SQL text from a strategy map; they share no code with the
Spark implementation, so the oracle checks engine semantics independently.
"""

from __future__ import annotations

from quarry.registry import ColumnStrategy, ImputerPolicy as I, NormalizationPolicy as N, OutlierPolicy as O

_MED = {I.MEDIAN, I.MEDIAN_WITH_MISSING_INDICATOR}
_ZERO = {I.ZERO, I.ZERO_WITH_MISSING_INDICATOR}
_IND = {I.MEDIAN_WITH_MISSING_INDICATOR, I.ZERO_WITH_MISSING_INDICATOR}
_PCTL = {O.PCTL_CLIP, O.PCTL_FILTER, O.CLIP_THEN_PCTL_CLIP}


def _lit(v):
    return "NULL" if v is None else repr(float(v))


def _clip(x: str, lo: str, hi: str) -> str:
    return f"(CASE WHEN {x} < {lo} THEN {lo} WHEN {x} > {hi} THEN {hi} ELSE {x} END)"


def stats_select(cols: list[str], strategies: dict[str, ColumnStrategy]) -> str:
    out = []
    for i, c in enumerate(cols):
        s = strategies[c]
        x = f"CAST({c} AS DOUBLE)"
        if s.imputer in _MED:
            out.append(f"quantile_cont({x}, 0.5) AS s{i}_med")
        if s.outlier in _PCTL:
            out += [f"quantile_cont({x}, {s.pctl_low}) AS s{i}_plo", f"quantile_cont({x}, {s.pctl_high}) AS s{i}_phi"]
        elif s.outlier == O.IQR_FILTER:
            out += [f"quantile_cont({x}, 0.25) AS s{i}_q1", f"quantile_cont({x}, 0.75) AS s{i}_q3"]
        if s.normalization == N.ROBUST_Z:
            out += [f"quantile_cont({x}, 0.25) AS s{i}_rq1", f"quantile_cont({x}, 0.5) AS s{i}_rmed",
                    f"quantile_cont({x}, 0.75) AS s{i}_rq3"]
        elif s.normalization == N.LOG1P:
            out.append(f"min({x}) AS s{i}_min")
        elif s.normalization == N.MINMAX:
            out += [f"min({x}) AS s{i}_min", f"max({x}) AS s{i}_max"]
    return ", ".join(out) or "1 AS s_dummy"


def gold_sql(src: str, keys: list[str], cols: list[str], strategies: dict[str, ColumnStrategy], *,
             fit_filter: str | None = None, apply_filter: str | None = None, mode: str = "clip",
             digits: int = 6) -> str:
    """Fit on ``src`` (optionally filtered), apply to ``src`` (optionally filtered)."""
    staged, inds, masks = [], [], []
    for i, c in enumerate(cols):
        s = strategies[c]
        x = f"CAST(src.{c} AS DOUBLE)"
        if s.imputer in _IND:
            inds.append(f"CAST(CASE WHEN src.{c} IS NULL THEN 1 ELSE 0 END AS TINYINT) AS {c}__is_missing")
        if s.imputer in _MED:
            x = f"coalesce({x}, st.s{i}_med)"
        if s.imputer in _ZERO:
            x = f"coalesce({x}, 0.0)"
        if s.outlier != O.NONE and (s.hard_min is not None or s.hard_max is not None):
            x = _clip(x, _lit(s.hard_min), _lit(s.hard_max))
        lo = hi = None
        if s.outlier in _PCTL:
            lo, hi = f"st.s{i}_plo", f"st.s{i}_phi"
        elif s.outlier == O.IQR_FILTER:
            lo = f"(st.s{i}_q1 - {s.iqr_k} * (st.s{i}_q3 - st.s{i}_q1))"
            hi = f"(st.s{i}_q3 + {s.iqr_k} * (st.s{i}_q3 - st.s{i}_q1))"
        if lo is not None:
            if mode == "clip":
                x = _clip(x, lo, hi)
            else:
                masks.append(f"(v_{c} IS NULL OR (v_{c} >= {lo} AND v_{c} <= {hi}))")
        staged.append(f"{x} AS v_{c}")
    finals = []
    for i, c in enumerate(cols):
        s = strategies[c]
        v = f"v_{c}"
        if s.normalization == N.LOG1P:
            sh = f"(CASE WHEN st.s{i}_min <= -1 THEN -st.s{i}_min + 1 ELSE 0.0 END)"
            e = f"(CASE WHEN {v} + {sh} > -1 THEN ln(1 + {v} + {sh}) END)"
        elif s.normalization == N.ROBUST_Z:
            iqr = f"(st.s{i}_rq3 - st.s{i}_rq1)"
            e = f"(({v} - st.s{i}_rmed) / (CASE WHEN {iqr} IS NULL OR {iqr} = 0 THEN 1.0 ELSE {iqr} END))"
        elif s.normalization == N.MINMAX:
            rng = f"(st.s{i}_max - st.s{i}_min)"
            e = f"(({v} - st.s{i}_min) / (CASE WHEN {rng} IS NULL OR {rng} = 0 THEN 1.0 ELSE {rng} END))"
        else:
            e = v
        finals.append(f"round({e}, {digits}) AS {c}")
    fit_src = f"(SELECT * FROM src WHERE {fit_filter})" if fit_filter else "src"
    app_where = f"WHERE {apply_filter}" if apply_filter else ""
    key_sel = ", ".join(f"src.{k}" for k in keys)
    key_out = ", ".join(keys)
    ind_names = [e.rsplit(" AS ", 1)[1] for e in inds]
    staged_sql = ", ".join([key_sel] + staged + inds)
    mask_sql = ("WHERE " + " AND ".join(masks)) if masks else ""
    return f"""
WITH src AS ({src}),
st AS (SELECT {stats_select(cols, strategies)} FROM {fit_src}),
staged AS (SELECT {staged_sql} FROM src CROSS JOIN st {app_where}),
kept AS (SELECT staged.* FROM staged CROSS JOIN st {mask_sql})
SELECT {", ".join([key_out] + finals + ind_names)} FROM kept CROSS JOIN st
"""


# ---------------------------------------------------------------------------------------------
# Oracle SQL per registered query
# ---------------------------------------------------------------------------------------------
from quarry.plans.gold import LINEITEM_STRATEGIES  # noqa: E402

ORACLE_SQL: dict[str, str] = {}

LINEITEM_GAPS = """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
  l_extendedprice, l_discount,
  CASE WHEN l_linenumber = 2 THEN NULL ELSE l_tax END AS l_tax
FROM lineitem"""
LINEITEM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_KEYS = ["l_orderkey", "l_linenumber"]

ORACLE_SQL["g1_gold"] = gold_sql(LINEITEM_GAPS, LI_KEYS, LINEITEM_COLS, LINEITEM_STRATEGIES)
ORACLE_SQL["g1_gold_distributed"] = ORACLE_SQL["g1_gold"]
ORACLE_SQL["g7_reapply"] = gold_sql(LINEITEM_GAPS, LI_KEYS, LINEITEM_COLS, LINEITEM_STRATEGIES,
                                    fit_filter="l_orderkey % 2 = 0", apply_filter="src.l_orderkey % 2 = 1")
ORACLE_SQL["o5_drop"] = gold_sql(LINEITEM_GAPS, LI_KEYS, LINEITEM_COLS, LINEITEM_STRATEGIES, mode="drop")

_SUFFIX = "(CASE WHEN day(o_orderdate) IN (1,21,31) THEN 'st' WHEN day(o_orderdate) IN (2,22) THEN 'nd' WHEN day(o_orderdate) IN (3,23) THEN 'rd' ELSE 'th' END)"
_TOKENS = "('[●]','[•]','—','-','NA','N/A','null','None','')"

ORACLE_SQL["p1_missing"] = f"""
WITH r AS (SELECT o_orderkey, CASE o_orderkey % 10 WHEN 0 THEN '[●]' WHEN 1 THEN ' NA ' WHEN 2 THEN 'N/A'
  WHEN 3 THEN '—' WHEN 4 THEN 'n/a' WHEN 5 THEN '  ' WHEN 6 THEN 'None' ELSE ' ' || o_orderpriority || chr(9) END AS raw
  FROM orders)
SELECT o_orderkey, raw, CASE WHEN trim(raw, ' ' || chr(9)) IN {_TOKENS} THEN NULL ELSE trim(raw, ' ' || chr(9)) END AS cleaned FROM r"""

ORACLE_SQL["p2_ordinal"] = "SELECT o_orderkey, day(o_orderdate) || ' ' || strftime(o_orderdate, '%B %Y') AS stripped FROM orders"

ORACLE_SQL["p3_money"] = """SELECT o_orderkey, round(CASE o_orderkey % 5 WHEN 0 THEN o_totalprice WHEN 1 THEN o_totalprice / 100
  WHEN 2 THEN o_totalprice WHEN 3 THEN o_totalprice ELSE NULL END, 6) AS crore FROM orders"""

ORACLE_SQL["p4_number"] = """SELECT c_custkey, round(CASE WHEN c_custkey % 5 IN (0, 1) THEN NULL ELSE c_acctbal END, 6) AS value
FROM customer"""

ORACLE_SQL["p5_percent"] = """SELECT l_orderkey, l_linenumber,
  round(CASE WHEN l_linenumber % 3 = 2 THEN NULL ELSE l_discount * 100 END, 6) AS pct FROM lineitem"""

ORACLE_SQL["p6_date"] = "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed FROM orders"

ORACLE_SQL["p7_slug"] = r"""SELECT p_partkey, nullif(trim(regexp_replace(regexp_replace(regexp_replace(
  lower(trim(' ' || p_name || ' & Co.  Ltd. ' || p_brand)), '\s+', '_', 'g'), '[^a-z0-9_]+', '_', 'g'), '_+', '_', 'g'), '_'), '') AS slug
FROM part"""

ORACLE_SQL["p9_listtext"] = r"""SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE
  trim(regexp_replace('[''' || p_name || ''',' || chr(10) || '   ''' || p_type || ''']  ', '\s+', ' ', 'g')) END AS objects
FROM part"""

ORACLE_SQL["p10_dispatch"] = """SELECT
  lower(c_name).regexp_replace('[^a-z0-9_]+', '_', 'g').regexp_replace('_+', '_', 'g').trim('_') AS company,
  round(c_acctbal, 6) AS issue_price,
  round(CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE c_acctbal END, 6) AS net_worth,
  round(CAST(c_nationkey AS DOUBLE), 6) AS allocation_qib,
  round(c_nationkey + 0.5, 6) AS subscription_retail_investors,
  CAST(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS DATE) AS open_date,
  c_mktsegment AS exchange,
  round(CAST(c_nationkey AS DOUBLE), 6) AS pre_issue_promoter_holding
FROM customer"""

_X1 = "html"
for _pat, _rep in [(r"(?is)<!--.*?-->", " "), (r"(?is)<!doctype[^>]*>", " "),
                   (r"(?is)<(script|style|template)\b[^>]*>.*?</(script|style|template)\s*>", " "),
                   (r"(?s)<[^>]*>", " "), ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&copy;", "©"),
                   ("&middot;", "·"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"), (" ", " "), (r"\s+", " ")]:
    _X1 = f"regexp_replace({_X1}, '{_pat.replace(chr(39), chr(39) * 2)}', '{_rep.replace(chr(39), chr(39) * 2)}', 'g')"
ORACLE_SQL["x1_text"] = f"SELECT page_id, trim({_X1}) AS text, length(trim({_X1})) AS n_chars FROM pages"

ORACLE_SQL["x13_first_number"] = "SELECT o_orderkey, round(o_totalprice, 6) AS gmp FROM orders"

_CAT_KEYS = ["anchor_investors", "qib_ex_anchor", "non_institutional_buyers", "bnii_bids_above_10l",
             "snii_bids_below_10l", "retail_investors", "employees", "shareholders", "market_maker", "qib",
             "retail_individual_investors_riis", "nii_hni_above_10_lakh"]
ORACLE_SQL["x19_category"] = ("SELECT c_custkey, CASE c_custkey % 12 " +
                              " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(_CAT_KEYS)) +
                              " END AS category_key FROM customer")

ORACLE_SQL["x20_slugify"] = r"""SELECT c_custkey, trim(regexp_replace(replace(replace(lower(c_name || ' & ' || c_mktsegment || ' (₹10L)'),
  '&', ' and '), '₹', ''), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM customer"""

ORACLE_SQL["x22_space"] = r"""SELECT p_partkey, p_type || ' ' || p_brand AS header, lower(p_type || ' ' || p_brand) AS header_norm FROM part"""

ORACLE_SQL["c5_url_id"] = r"""WITH p AS (SELECT page_id, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path FROM pages)
SELECT page_id, coalesce(list_filter(string_split(path, '/'), lambda s: regexp_full_match(s, '\d+'))[-1],
  nullif(regexp_extract(path, '(\d+)/?$', 1), '')) AS ipo_id FROM p"""

ORACLE_SQL["c6_storage_key"] = "SELECT p_partkey, replace(lower(p_name || ' ' || p_brand), ' ', '_') AS key FROM part"

ORACLE_SQL["c8_json"] = r"""SELECT event_id AS id, 'events' AS src, regexp_matches(ltrim(props), '^[\[{]') AS is_json FROM events
UNION ALL SELECT page_id, 'pages', regexp_matches(ltrim(html), '^[\[{]') FROM pages"""


# ---------------------------------------------------------------------------------------------
# Section pages rendered from customer: expected fields straight from the customer row
# ---------------------------------------------------------------------------------------------
_CU = "(SELECT *, lower(replace(c_name, '#', '_')) AS company, abs(c_acctbal) AS ab, c_custkey AS c, c_nationkey AS n FROM customer)"
_T = "c % 3 = 0"  # table-only financial pages

FIN_EXPECTED = f"""SELECT company,
  CASE WHEN {_T} THEN NULL ELSE ab + 1000 END AS assets,
  CASE WHEN {_T} THEN ab + 1 ELSE ab END AS net_worth,
  CASE WHEN {_T} THEN NULL ELSE n * 10 + 0.5 END AS total_debt,
  ab * 2 AS revenue,
  CASE WHEN {_T} THEN NULL ELSE c % 500 + 0.75 END AS ebitda,
  c % 300 + 0.5 AS pat,
  n + 0.5 AS ebitda_margin,
  n + 0.25 AS pat_margin,
  CASE WHEN {_T} THEN NULL ELSE c_acctbal / 100 END AS eps,
  CASE WHEN {_T} THEN NULL ELSE n - 9.5 END AS roe,
  CASE WHEN {_T} THEN NULL ELSE n * 2.0 END AS roce,
  CASE WHEN {_T} THEN NULL ELSE n / 4 END AS roa,
  n / 10 AS debt_to_equity,
  CASE WHEN {_T} THEN NULL ELSE ab * 3 END AS market_capitalisation,
  CASE WHEN {_T} THEN NULL ELSE c % 40 + 0.5 END AS ev_ebitda,
  CASE WHEN {_T} THEN NULL ELSE n / 5 END AS pb_multiple,
  CASE WHEN {_T} THEN NULL ELSE c_acctbal / 10 END AS nav,
  CASE WHEN {_T} THEN NULL ELSE ab + 500 END AS enterprise_value,
  CASE WHEN {_T} THEN NULL ELSE c % 60 + 0.5 END AS pe_multiple
FROM {_CU}"""

PERF_EXPECTED = f"""SELECT company, CASE WHEN c % 2 = 0 THEN 10.0 ELSE 5.0 END AS face_value, ab AS issue_price,
  ab + 5 AS listing_price, n - 12.5 AS listing_gain FROM {_CU}"""

_OBJ = " || ' | ' || ".join(["'The net proceeds will be used for:'"] +
                              [f"'Item {i}: capex for ' || company" for i in range(1, 13)])
INFO_EXPECTED = f"""SELECT company,
  CASE WHEN c % 2 = 0 THEN 'Mainboard' ELSE 'SME' END AS ipo_category,
  CASE WHEN c % 2 = 0 THEN 'BSE, NSE' ELSE 'NSE SME' END AS exchange,
  CASE WHEN c % 3 = 0 THEN 'Fixed Price' ELSE 'Book Built' END AS issue_type,
  ab AS issue_price, c % 60 + 1.5 AS pe_multiple, (c % 400) / 4.0 AS subscription,
  n * 3 + 0.5 AS pre_issue_promoter_holding, n * 2 + 0.5 AS post_issue_promoter_holding,
  CAST(DATE '2020-01-01' + CAST(c % 1000 AS INTEGER) - 60 AS DATE) AS dhrp_date,
  CAST(DATE '2020-01-01' + CAST(c % 1000 AS INTEGER) AS DATE) AS open_date,
  CAST(DATE '2020-01-01' + CAST(c % 1000 AS INTEGER) + 2 AS DATE) AS close_date,
  CAST(DATE '2020-01-01' + CAST(c % 1000 AS INTEGER) + 5 AS DATE) AS allotment_date,
  CAST(DATE '2020-01-01' + CAST(c % 1000 AS INTEGER) + 7 AS DATE) AS listing_date,
  {_OBJ} AS object_of_issue
FROM {_CU}"""

GMP_EXPECTED = f"""SELECT company, CAST(n AS DOUBLE) AS ipo_open_gmp, CAST(c % 100 - 50 AS DOUBLE) AS ipo_close_gmp,
  CASE WHEN c % 2 = 0 THEN ab END AS ipo_allotment_gmp, CASE WHEN c % 2 = 0 THEN c * 10.0 END AS ipo_listing_gmp
FROM {_CU}"""

_P = "c % 5 = 0"  # pending subscription pages (no table)
SUB_EXPECTED = f"""SELECT company,
  CASE WHEN {_P} THEN NULL ELSE 30.0 + n % 10 END AS allocation_anchor_investors,
  CASE WHEN {_P} THEN NULL ELSE 20.0 END AS allocation_qib_ex_anchor,
  CASE WHEN {_P} THEN NULL ELSE 35.5 END AS allocation_retail_investors,
  CASE WHEN {_P} THEN NULL ELSE 100.0 END AS allocation_total_ipo_subscription,
  CASE WHEN {_P} THEN NULL ELSE 1.0 END AS subscription_anchor_investors,
  CASE WHEN {_P} THEN NULL ELSE n + 0.25 END AS subscription_bnii_bids_above_10l,
  CASE WHEN {_P} THEN NULL ELSE n / 2 END AS subscription_employees,
  CASE WHEN {_P} THEN NULL ELSE n + 0.73 END AS subscription_non_institutional_buyers,
  CASE WHEN {_P} THEN NULL ELSE c % 50 + 0.06 END AS subscription_qib_ex_anchor,
  CASE WHEN {_P} THEN NULL ELSE c % 30 + 0.04 END AS subscription_retail_investors,
  CASE WHEN {_P} THEN NULL ELSE n + 0.68 END AS subscription_snii_bids_below_10l
FROM {_CU}"""


def _rounded(sql: str, cols_text: list[str]) -> str:
    """Wrap a select so that every DOUBLE column is rounded to 6 digits."""
    return f"SELECT * REPLACE ({', '.join(f'round(CAST({c} AS DOUBLE), 6) AS {c}' for c in cols_text)}) FROM ({sql})"


_FIN_COLS = ["assets", "net_worth", "total_debt", "revenue", "ebitda", "pat", "ebitda_margin", "pat_margin", "eps",
             "roe", "roce", "roa", "debt_to_equity", "market_capitalisation", "ev_ebitda", "pb_multiple", "nav",
             "enterprise_value", "pe_multiple"]
ORACLE_SQL["x5_financials"] = _rounded(FIN_EXPECTED, _FIN_COLS)
ORACLE_SQL["x6_performance"] = _rounded(PERF_EXPECTED, ["face_value", "issue_price", "listing_price", "listing_gain"])
ORACLE_SQL["x7_x8_information"] = _rounded(
    f"SELECT *, CAST(13 AS INTEGER) AS n_objects FROM ({INFO_EXPECTED})",
    ["issue_price", "pe_multiple", "subscription", "pre_issue_promoter_holding", "post_issue_promoter_holding"])
ORACLE_SQL["x11_x15_gmp"] = _rounded(GMP_EXPECTED, ["ipo_open_gmp", "ipo_close_gmp", "ipo_allotment_gmp",
                                                    "ipo_listing_gmp"])
_SUB_COLS = ["allocation_anchor_investors", "allocation_qib_ex_anchor", "allocation_retail_investors",
             "allocation_total_ipo_subscription", "subscription_anchor_investors", "subscription_bnii_bids_above_10l",
             "subscription_employees", "subscription_non_institutional_buyers", "subscription_qib_ex_anchor",
             "subscription_retail_investors", "subscription_snii_bids_below_10l"]
ORACLE_SQL["x17_x18_subscription"] = _rounded(SUB_EXPECTED, _SUB_COLS)
ORACLE_SQL["s7_discovered_keys"] = ("SELECT field, count(*) AS pages FROM (SELECT unnest([" +
                                    ", ".join(f"'{k}'" for k in _SUB_COLS) +
                                    f"]) AS field FROM {_CU} WHERE NOT ({_P})) GROUP BY field")
ORACLE_SQL["x1_references"] = """SELECT p_partkey, p_name || chr((p_partkey % 90 + 33)::INT) || chr((p_partkey % 90 + 8385)::INT)
  || '’&lt; &bogus;₹ ½' AS text FROM part"""
ORACLE_SQL["x3_labels"] = """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN round(abs(c_acctbal), 2) END AS assets, c_nationkey::DOUBLE AS ebitda,
  7.5::DOUBLE AS ebitda_margin, NULL::DOUBLE AS pat, round(abs(c_acctbal), 2) AS revenue, -c_nationkey::DOUBLE AS eps, NULL::DOUBLE AS ev_ebitda FROM customer"""
ORACLE_SQL["s10_base_table"] = "SELECT c_mktsegment AS segment, c_custkey, c_name, round(c_acctbal, 6) AS c_acctbal FROM customer"
ORACLE_SQL["q9_preview"] = """SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice, o_orderpriority FROM orders
ORDER BY o_orderpriority NULLS LAST, orders.o_totalprice NULLS LAST, o_orderkey LIMIT 20"""
ORACLE_SQL["f4_override"] = """SELECT c_name AS company, CAST(NULL AS DOUBLE) AS issue_price,
  CASE WHEN c_custkey % 4 <> 1 THEN format('{:,.2f}', c_acctbal) END AS net_worth, c_nationkey || '%' AS allocation_qib,
  c_nationkey::DOUBLE AS pre_issue_promoter_holding FROM customer"""
ORACLE_SQL["x25_failures"] = r"""
WITH h AS (SELECT page_id, substr(html, 1, CAST(floor(length(html) * (page_id % 5) / 4) AS BIGINT)) AS html FROM pages),
e AS (SELECT page_id, CASE WHEN html IS NULL OR NOT regexp_matches(html, '\S') THEN 'no content'
                           WHEN regexp_matches(html, '(?s)<[A-Za-z/!?][^>]*\z') THEN 'cut inside a tag'
                           WHEN contains(lower(html), '<html') AND NOT contains(lower(html), '</html') THEN 'no end of page' END AS error FROM h)
SELECT page_id, error, (SELECT count(*) FROM e) AS n_pages, (SELECT count(error) FROM e) AS n_failed FROM e WHERE error IS NOT NULL"""
ORACLE_SQL["c9_complete"] = f"SELECT company, NOT ({_P}) AS complete FROM {_CU}"

SILVER_EXPECTED = f"""SELECT CASE WHEN cu.c % 2 = 0 THEN 'mainboard' ELSE 'sme' END AS segment, cu.company,
  {", ".join("f." + c for c in _FIN_COLS if c != "pe_multiple")},
  g.ipo_open_gmp, g.ipo_close_gmp, g.ipo_allotment_gmp, g.ipo_listing_gmp,
  i.ipo_category, i.exchange, i.issue_type, i.pe_multiple, i.subscription, i.pre_issue_promoter_holding,
  i.post_issue_promoter_holding, i.dhrp_date, i.open_date, i.close_date, i.allotment_date, i.listing_date,
  i.object_of_issue,
  p.face_value, p.issue_price, p.listing_price, p.listing_gain,
  {", ".join("s." + c for c in _SUB_COLS)}
FROM {_CU} cu
LEFT JOIN ({FIN_EXPECTED}) f ON f.company = cu.company
LEFT JOIN ({GMP_EXPECTED}) g ON g.company = cu.company
LEFT JOIN ({INFO_EXPECTED}) i ON i.company = cu.company
LEFT JOIN ({PERF_EXPECTED}) p ON p.company = cu.company
LEFT JOIN ({SUB_EXPECTED}) s ON s.company = cu.company"""
_SILVER_DOUBLES = ([c for c in _FIN_COLS if c != "pe_multiple"] +
                   ["ipo_open_gmp", "ipo_close_gmp", "ipo_allotment_gmp", "ipo_listing_gmp", "pe_multiple",
                    "subscription", "pre_issue_promoter_holding", "post_issue_promoter_holding", "face_value",
                    "issue_price", "listing_price", "listing_gain"] + _SUB_COLS)
ORACLE_SQL["s14_silver"] = _rounded(SILVER_EXPECTED, _SILVER_DOUBLES)
ORACLE_SQL["s11_s14_incremental"] = ORACLE_SQL["s14_silver"]
ORACLE_SQL["s5_typed"] = """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN round(o_totalprice, 6) END AS o_totalprice,
  CASE WHEN o_orderkey % 3 = 0 THEN 'say "' || o_orderpriority || '",' || chr(10) || 'then stop' ELSE o_orderpriority END AS note,
  o_orderkey % 7 = 0 AS rejected FROM orders"""

from quarry.plans.gold import FEATURE_GROUPS  # noqa: E402
from quarry.registry import Registry  # noqa: E402

_REG = Registry().strategy_map()
_CUSTOM = FEATURE_GROUPS["custom"]
ORACLE_SQL["g1_listing_gold"] = gold_sql(SILVER_EXPECTED, ["company"], _CUSTOM, _REG)


# ---------------------------------------------------------------------------------------------
# Aggregations, imputation, outliers, normalisation, artifacts
# ---------------------------------------------------------------------------------------------
from quarry.plans.catalog import (CUSTOMER_NORM, EVENTS_STRATEGIES, LI_NUM, ORDERS_OUTLIER,  # noqa: E402
                                  PROBS)

ORACLE_SQL["a1_a2_quantiles"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST({p} AS DOUBLE) AS prob, round(quantile_cont({c}, {p}), 6) AS value FROM lineitem"
    for c in LI_NUM for p in PROBS)

_ORD_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORACLE_SQL["a6_profile"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column, (SELECT CASE typeof({c}) WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' "
    f"WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(typeof({c})) END FROM orders LIMIT 1) AS dtype, "
    f"count({c}) AS non_null, count(*) - count({c}) AS nulls, "
    f"count(DISTINCT {c}) AS \"distinct\" FROM orders" for c in _ORD_COLS)

ORACLE_SQL["a6_profile_sketch"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column, count({c}) AS non_null, count(*) - count({c}) AS nulls, true AS within FROM orders"
    for c in _ORD_COLS if c != "o_orderpriority")

ORACLE_SQL["a7_describe"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    f"round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
    f"round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM lineitem" for c in LI_NUM)

EVENTS_GAPS = """SELECT event_id,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
  CASE WHEN event_type = 'error' THEN NULL ELSE json_extract_string(props, '$.k') END AS k,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id END AS user_id
FROM events"""
ORACLE_SQL["i1_i4_impute"] = gold_sql(EVENTS_GAPS, ["event_id"], list(EVENTS_STRATEGIES), EVENTS_STRATEGIES)
ORACLE_SQL["i6_fill_zero"] = f"""SELECT event_id, round(coalesce(value, 0), 6) AS value,
  round(coalesce(CAST(k AS DOUBLE), 0), 6) AS k, coalesce(user_id, 0) AS user_id FROM ({EVENTS_GAPS})"""

ORDERS_OUT_SRC = """SELECT o_orderkey, o_totalprice, o_custkey,
  CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS o_shippriority FROM orders"""
ORACLE_SQL["o2_o4_clip"] = gold_sql(ORDERS_OUT_SRC, ["o_orderkey"], list(ORDERS_OUTLIER), ORDERS_OUTLIER)
ORACLE_SQL["o5_o6_drop_orders"] = gold_sql(ORDERS_OUT_SRC, ["o_orderkey"], list(ORDERS_OUTLIER), ORDERS_OUTLIER,
                                           mode="drop")

CUSTOMER_NORM_SRC = "SELECT c_custkey, " + ", ".join(f"c_acctbal AS {n}" for n in CUSTOMER_NORM) + " FROM customer"
ORACLE_SQL["z1_z7_normalize"] = gold_sql(CUSTOMER_NORM_SRC, ["c_custkey"], list(CUSTOMER_NORM), CUSTOMER_NORM)


def artifact_sql(src: str, cols: list[str], strategies) -> str:
    """Expected artifact rows (column, stat, value) from the same stats as ``gold_sql``."""
    rows = []
    for i, c in enumerate(cols):
        s = strategies[c]
        if s.imputer in _MED:
            rows.append((c, "median", f"s{i}_med"))
        if s.imputer in _ZERO:
            rows.append((c, "zero_fill", "0.0"))
        if s.imputer in _IND:
            rows.append((c, "missing_indicator", "1.0"))
        if s.outlier != O.NONE:
            rows += [(c, "hard_min", _lit(s.hard_min)), (c, "hard_max", _lit(s.hard_max))]
        if s.outlier in _PCTL:
            rows += [(c, "pctl_low", f"s{i}_plo"), (c, "pctl_high", f"s{i}_phi")]
        elif s.outlier == O.IQR_FILTER:
            rows += [(c, "iqr_low", f"s{i}_q1 - {s.iqr_k} * (s{i}_q3 - s{i}_q1)"),
                     (c, "iqr_high", f"s{i}_q3 + {s.iqr_k} * (s{i}_q3 - s{i}_q1)")]
        if s.normalization == N.LOG1P:
            rows.append((c, "log1p_shift", f"CASE WHEN s{i}_min <= -1 THEN -s{i}_min + 1 ELSE 0.0 END"))
        elif s.normalization == N.ROBUST_Z:
            rows += [(c, "robust_median", f"s{i}_rmed"),
                     (c, "robust_iqr", f"CASE WHEN s{i}_rq3 - s{i}_rq1 IS NULL OR s{i}_rq3 - s{i}_rq1 = 0 THEN 1.0 "
                                       f"ELSE s{i}_rq3 - s{i}_rq1 END")]
        elif s.normalization == N.MINMAX:
            rows += [(c, "minmax_min", f"s{i}_min"), (c, "minmax_max", f"s{i}_max")]
    st = f"(SELECT {stats_select(cols, strategies)} FROM ({src}))"
    return " UNION ALL ".join(f"SELECT '{c}' AS column, '{k}' AS stat, round(CAST({e} AS DOUBLE), 6) AS value FROM {st}"
                              for c, k, e in rows)


ORACLE_SQL["s12_artifacts"] = artifact_sql(LINEITEM_GAPS, LINEITEM_COLS, LINEITEM_STRATEGIES)

ORACLE_SQL["q5_iqr_filter"] = """SELECT l_orderkey, l_linenumber, round(l_quantity, 6) AS l_quantity FROM lineitem,
  (SELECT quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.75) AS q3 FROM lineitem) s
WHERE l_quantity >= q1 - 0.5 * (q3 - q1) AND l_quantity <= q3 + 0.5 * (q3 - q1)"""
ORACLE_SQL["q6_pctl_filter"] = """SELECT l_orderkey, l_linenumber, round(l_extendedprice, 6) AS l_extendedprice FROM lineitem,
  (SELECT quantile_cont(l_extendedprice, 0.01) AS lo, quantile_cont(l_extendedprice, 0.99) AS hi FROM lineitem) s
WHERE l_extendedprice >= lo AND l_extendedprice <= hi"""

_seq = [f"t0 AS (SELECT l_orderkey, l_linenumber, " +
        ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in LI_NUM) + f" FROM ({LINEITEM_GAPS}))"]
for _i, _c in enumerate(LI_NUM, 1):
    _seq.append(f"t{_i} AS (SELECT t{_i-1}.* FROM t{_i-1}, (SELECT quantile_cont({_c}, 0.25) AS q1, "
                f"quantile_cont({_c}, 0.75) AS q3 FROM t{_i-1}) s WHERE {_c} >= q1 - 1.0 * (q3 - q1) "
                f"AND {_c} <= q3 + 1.0 * (q3 - q1))")
ORACLE_SQL["q7_sequential_iqr"] = ("WITH " + ", ".join(_seq) + " SELECT l_orderkey, l_linenumber, " +
                                   ", ".join(f"round({c}, 6) AS {c}" for c in LI_NUM) + f" FROM t{len(LI_NUM)}")



def _pair_rho(a: str, b: str) -> str:
    rank = "rank() OVER (ORDER BY {0}) + (count(*) OVER (PARTITION BY {0}) - 1) / 2.0"
    return (f"round(corr(x, y), 6) AS rho FROM (SELECT {rank.format('a')} AS x, {rank.format('b')} AS y FROM "
            f"(SELECT CAST({a} AS DOUBLE) AS a, CAST({b} AS DOUBLE) AS b FROM ({LINEITEM_GAPS})) "
            f"WHERE a IS NOT NULL AND b IS NOT NULL)")


_SPEARMAN = " UNION ALL ".join(
    f"SELECT {i} AS i, {j} AS j, '{a}' AS col_i, '{b}' AS col_j, "
    + ("CAST(1.0 AS DOUBLE) AS rho" if i == j else _pair_rho(a, b))
    for i, a in enumerate(LI_NUM) for j, b in enumerate(LI_NUM))
ORACLE_SQL["m4_m5_pca_correlation"] = " UNION ALL ".join(
    f"SELECT '{a}' AS col_i, '{b}' AS col_j, round(corr({a}, {b}), 6) AS corr, CAST(1.0 AS DOUBLE) AS all_ratios "
    f"FROM lineitem" for a in LI_NUM for b in LI_NUM)
ORACLE_SQL["m1_spearman"] = _SPEARMAN
ORACLE_SQL["m2_weak_correlation"] = (f"SELECT col_j AS column, max(CASE WHEN abs(rho) < 0.2 THEN 1 ELSE 0 END) = 1 "
                                     f"AS weak FROM ({_SPEARMAN}) WHERE i < j GROUP BY col_j")
ORACLE_SQL["m3_standardize"] = ("SELECT " + ", ".join(f"round(({c} - m{i}) / s{i}, 6) AS {c}" for i, c in enumerate(LI_NUM)) +
                                " FROM lineitem, (SELECT " +
                                ", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS s{i}" for i, c in enumerate(LI_NUM)) +
                                " FROM lineitem) st")

# principal components from the correlation matrix: squaring it until one component is left, then taking that one out
_EIGEN = f"""
WITH RECURSIVE m AS (SELECT [{", ".join("[" + ", ".join("1.0" if a == b else f"corr({a}, {b})" for b in LI_NUM) + "]" for a in LI_NUM)}] AS a FROM lineitem),
e AS (
  SELECT 0 AS pc, a, CAST(NULL AS DOUBLE[]) AS v, CAST(0 AS DOUBLE) AS value FROM m
  UNION ALL
  SELECT pc, list_transform(a, lambda r, i: list_transform(r, lambda x, j: x - value * v[i] * v[j])), v, value
  FROM (SELECT pc, a, v, list_dot_product(v, list_transform(a, lambda r: list_dot_product(r, v))) AS value
  FROM (SELECT pc, a, list_transform(big, lambda x: x / sqrt(list_dot_product(big, big))) AS v
  FROM (SELECT pc, a, list_extract(list_sort(list_transform(p, lambda r: {{'n': list_dot_product(r, r), 'r': r}}), 'DESC'), 1).r AS big
  FROM (SELECT pc + 1 AS pc, a, list_reduce(list_prepend(a, list_transform(range(60), lambda i: a)), lambda q, x:
          list_transform(q, lambda r: list_transform(q, lambda c: list_dot_product(r, c) / list_sum(list_transform(q, lambda t: list_dot_product(t, t)))))) AS p
        FROM e WHERE pc < {len(LI_NUM)}))))),
pcs AS (SELECT pc, value / {len(LI_NUM)} AS ratio, v FROM e WHERE pc > 0)
"""
ORACLE_SQL["m4_a9_pca_variance"] = _EIGEN + ("SELECT CAST(pc AS INT) AS pc, round(ratio, 6) AS explained_ratio, "
                                             "round(sum(ratio) OVER (ORDER BY pc), 6) AS cumulative FROM pcs")
ORACLE_SQL["m5_m6_importance"] = _EIGEN + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(sum(abs(v[{i + 1}]) * ratio), 6) AS importance FROM pcs" for i, c in enumerate(LI_NUM))

# ---------------------------------------------------------------------------------------------
# Projection, joins, unions, dedup
# ---------------------------------------------------------------------------------------------
_CHAIN = """WITH c AS (SELECT c_custkey AS key, c_name AS name, c_acctbal AS bal, c_mktsegment FROM customer),
o AS (SELECT o_custkey AS key, o_orderkey, o_totalprice AS bal, o_orderstatus FROM orders WHERE o_custkey IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1),
s AS (SELECT s_suppkey AS key, s_name AS name, s_acctbal AS bal FROM supplier)"""
ORACLE_SQL["j1_join_chain"] = _CHAIN + """
SELECT c.key, c.name AS name_x, round(c.bal, 6) AS bal_x, c.c_mktsegment, o.o_orderkey, round(o.bal, 6) AS bal_y,
  o.o_orderstatus, s.name AS name_y, round(s.bal, 6) AS bal
FROM c LEFT JOIN o ON c.key = o.key LEFT JOIN s ON c.key = s.key"""
ORACLE_SQL["j2_resolve"] = _CHAIN + """
SELECT c.key, c.c_mktsegment, o.o_orderkey, round(o.bal, 6) AS order_total, o.o_orderstatus, round(s.bal, 6) AS bal,
  coalesce(s.name, c.name) AS name
FROM c LEFT JOIN o ON c.key = o.key LEFT JOIN s ON c.key = s.key"""

_UNION = """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
UNION ALL BY NAME SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority, o_custkey FROM orders"""
ORACLE_SQL["u1_s7_union"] = f"SELECT * REPLACE (round(o_totalprice, 6) AS o_totalprice) FROM ({_UNION})"
ORACLE_SQL["a5_u2_dedup"] = f"""SELECT * REPLACE (round(o_totalprice, 6) AS o_totalprice) FROM ({_UNION})
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey NULLS LAST, o_totalprice NULLS LAST,
  o_orderdate NULLS LAST, o_orderpriority NULLS LAST) = 1"""
ORACLE_SQL["q1_q3_projection"] = "SELECT o_orderkey, round(o_totalprice, 6) AS total FROM orders"

# ---------------------------------------------------------------------------------------------
# Crawl work-list and I/O
# ---------------------------------------------------------------------------------------------
_BASE = "https://listings.example"
_dyn = {"draw": "CAST(page AS VARCHAR)", "start": "CAST((page - 1) * 10 AS VARCHAR)",
        "_": "CAST(1700000000000 + page AS VARCHAR)"}
_LISTS = {
    "sme": ("SME", ["company_link company_name", "listing_year listing_year", "city_sme company_location",
                    "sector sectors.name", "ipo_sizee ipo_size", "pe+Ratio price_to_earning", "exchange exchange",
                    "merchant_banker merchant_banker"]),
    "mainboard": ("MainBoard", ["company_link company_name", "ipo_year_mb ipo_year", "city company_location",
                                "sector sectors.name", "ipo_sizee ipo_size", "pe+Ratio price_to_earning",
                                "merchant_banker_mainboard merchant_banker_mainboard"]),
}


def _list_url(segment: str) -> str:
    kind, columns = _LISTS[segment]
    cols = "".join("&columns%5B{0}%5D%5Bdata%5D={1}&columns%5B{0}%5D%5Bname%5D={2}&columns%5B{0}%5D%5Bsearchable%5D=true"
                   "&columns%5B{0}%5D%5Borderable%5D=true&columns%5B{0}%5D%5Bsearch%5D%5Bvalue%5D="
                   "&columns%5B{0}%5D%5Bsearch%5D%5Bregex%5D=false".format(i, *c.split(" ")) for i, c in enumerate(columns))
    return (f"'{_BASE}/main-board/index?draw=' || {_dyn['draw']} || '{cols}&start=' || {_dyn['start']} || "
            f"'&length=10&search%5Bvalue%5D=&search%5Bregex%5D=false&ipo_type={kind}&_=' || {_dyn['_']}")


ORACLE_SQL["c1_manifest"] = f"""SELECT c_mktsegment, segment, CAST(page AS INTEGER) AS page,
  CASE segment WHEN 'sme' THEN {_list_url('sme')} ELSE {_list_url('mainboard')} END AS url
FROM (SELECT c_mktsegment, segment, unnest(generate_series(1, CAST(ceil(count(*) / 10) AS BIGINT))) AS page
      FROM (SELECT *, CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'sme' ELSE 'mainboard' END AS segment
            FROM customer) GROUP BY c_mktsegment, segment)"""

_FAN_BASE = "(SELECT c_custkey AS id, replace(lower(c_name || ' Ltd'), ' ', '_') AS company, lower(replace(c_name, '#', '-')) AS slug FROM customer)"
_TPL = [("ipo_information", "/ipo/"), ("financials", "/ipo/financial-report/"), ("subscription", "/ipo/subscription/"),
        ("peers", "/ipo/peer-comparison/"), ("performance_report", "/ipo/performance-report/"),
        ("review", "/ipo/review/")]
_FANOUT = " UNION ALL ".join(
    [f"SELECT company, '{s}' AS section, '{_BASE}{p}' || slug || '/' || id AS url FROM {_FAN_BASE}" for s, p in _TPL] +
    [f"SELECT company, 'gmp' AS section, '{_BASE}/gmp/' || slug || '/' || id || '/' AS url FROM {_FAN_BASE} WHERE id % 3 <> 0"])
ORACLE_SQL["c2_c4_fanout"] = f"""SELECT company, section, url, CASE WHEN contains(url, '/gmp/') THEN 'gmp'
  WHEN contains(url, '/subscription/') THEN 'subscription' ELSE 'generic' END AS handler FROM ({_FANOUT})"""
ORACLE_SQL["c3_pending"] = f"""SELECT company, section FROM ({_FANOUT})
WHERE section NOT IN ('financials', 'gmp', 'ipo_information', 'performance_report', 'subscription')"""

ORACLE_SQL["c7_status"] = r"""WITH l AS (SELECT event_id,
  CASE event_type WHEN 'error' THEN 503 WHEN 'click' THEN 429 WHEN 'signup' THEN 404 ELSE 200 END AS status,
  CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 = 0 THEN '{"msg": 0, "error": "blocked"}'
       ELSE props END AS body FROM events)
SELECT event_id, status, CASE
  WHEN status BETWEEN 200 AND 299 AND regexp_matches(ltrim(body), '^[\[{]') AND json_extract(body, '$.k') IS NOT NULL THEN 'success'
  WHEN status = 429 OR status BETWEEN 500 AND 599 OR (status BETWEEN 200 AND 299 AND json_extract(body, '$.error') IS NOT NULL
       AND json_extract(body, '$.msg') IS NOT NULL) THEN 'retry'
  ELSE 'fail' END AS outcome FROM l"""

ORACLE_SQL["s8_payload"] = "SELECT o_orderkey, o_orderstatus FROM orders"
ORACLE_SQL["s4_s6_csv_roundtrip"] = """SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice,
  CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders"""

_GROUPS = FEATURE_GROUPS
_SILVER_COLS = set(_SILVER_DOUBLES)
_UNION_COLS = []
for _cols in _GROUPS.values():
    _UNION_COLS += [c for c in _cols if c in _SILVER_COLS and c not in _UNION_COLS]
_GOLD_ALL = gold_sql(SILVER_EXPECTED, ["company"], _UNION_COLS, _REG)
_LABELS = ["ipo_category", "exchange", "issue_type", "dhrp_date", "open_date", "close_date", "allotment_date",
           "listing_date", "object_of_issue"]
ORACLE_SQL["g2_groups"] = " UNION ALL ".join(
    [f"SELECT '{g}' AS \"group\", company, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS label "
     f"FROM ({_GOLD_ALL})" for g, cols in _GROUPS.items() for c in cols if c in _SILVER_COLS] +
    [f"SELECT 'all_cols' AS \"group\", company, '{c}' AS feature, CAST(NULL AS DOUBLE) AS value, "
     f"CAST({c} AS VARCHAR) AS label FROM ({SILVER_EXPECTED})" for c in _LABELS])
