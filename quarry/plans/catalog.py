"""Registered queries: each operator of the library run over the provided tables.

Every query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over whole
tables.  Floating results are rounded to 6 digits so that hashes are stable
across engines.  Names follow the operator ids of the blueprint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.util import read_table, round_doubles
from ..operators.apply import Artifacts, transform
from ..operators.fit import fit
from .gold import LINEITEM_STRATEGIES, create_gold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def lineitem_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with deterministic missing values injected (the tables have none)."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 7 == 0, None).otherwise(F.col("l_quantity")).alias("l_quantity"),
        "l_extendedprice", "l_discount",
        F.when(F.col("l_linenumber") == 2, None).otherwise(F.col("l_tax")).alias("l_tax"),
    )


LINEITEM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("g1_gold")
def g1_gold(spark, sf_dir):
    src = lineitem_with_gaps(spark, sf_dir)
    res = create_gold(src, LINEITEM_STRATEGIES, LINEITEM_COLS, keep=["l_orderkey", "l_linenumber"])
    return round_doubles(res.features)


@query("g1_gold_distributed")
def g1_gold_distributed(spark, sf_dir):
    """G1 with the distributed exact quantile method (same result as ``g1_gold``)."""
    src = lineitem_with_gaps(spark, sf_dir)
    res = create_gold(src, LINEITEM_STRATEGIES, LINEITEM_COLS, keep=["l_orderkey", "l_linenumber"],
                      method="distributed")
    return round_doubles(res.features)


@query("g7_reapply")
def g7_reapply(spark, sf_dir):
    src = lineitem_with_gaps(spark, sf_dir)
    art = fit(src.where(F.col("l_orderkey") % 2 == 0), LINEITEM_STRATEGIES, LINEITEM_COLS)
    out = transform(src.where(F.col("l_orderkey") % 2 == 1), Artifacts.from_frame(art), LINEITEM_COLS,
                    keep=["l_orderkey", "l_linenumber"])
    return round_doubles(out)


@query("o5_drop")
def o5_drop(spark, sf_dir):
    src = lineitem_with_gaps(spark, sf_dir)
    res = create_gold(src, LINEITEM_STRATEGIES, LINEITEM_COLS, mode="drop", keep=["l_orderkey", "l_linenumber"])
    return round_doubles(res.features)


# ---------------------------------------------------------------------------------------------
# Scalar cleaners (P1-P12) over strings rendered from the provided tables
# ---------------------------------------------------------------------------------------------
from ..functions import clean as C  # noqa: E402
from ..functions import text as X  # noqa: E402
from ..functions import url as U  # noqa: E402


def _ordinal_suffix(day: F.Column) -> F.Column:
    return (F.when(day.isin(1, 21, 31), "st").when(day.isin(2, 22), "nd")
            .when(day.isin(3, 23), "rd").otherwise("th"))


@query("p1_missing")
def p1_missing(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 10
    raw = (F.when(k == 0, "[●]").when(k == 1, " NA ").when(k == 2, "N/A").when(k == 3, "—")
           .when(k == 4, "n/a").when(k == 5, "  ").when(k == 6, "None")
           .otherwise(F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit("\t"))))
    return o.select("o_orderkey", raw.alias("raw")).select("o_orderkey", "raw", C.missing_to_null("raw").alias("cleaned"))


@query("p2_ordinal")
def p2_ordinal(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    d = F.dayofmonth("o_orderdate")
    raw = F.concat(d.cast("string"), _ordinal_suffix(d), F.lit(" "), F.date_format("o_orderdate", "MMMM yyyy"))
    return o.select("o_orderkey", C.strip_ordinal(raw).alias("stripped"))


@query("p3_money")
def p3_money(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 5
    amt = F.format_number("o_totalprice", 2)
    raw = (F.when(k == 0, F.concat(F.lit("₹ "), amt, F.lit(" Cr.")))
           .when(k == 1, F.concat(F.lit("₹ "), amt, F.lit(" Lakh")))
           .when(k == 2, amt)
           .when(k == 3, F.concat(amt, F.lit(" crore")))
           .otherwise(F.lit("[●]")))
    return round_doubles(o.select("o_orderkey", C.parse_money_crore(raw).alias("crore")))


@query("p4_number")
def p4_number(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 5
    raw = F.when(k == 0, "N/A").when(k == 1, "abc").otherwise(F.format_number("c_acctbal", 2))
    return round_doubles(c.select("c_custkey", C.parse_number(raw).alias("value")))


@query("p5_percent")
def p5_percent(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    k = F.col("l_linenumber") % 3
    pct = (F.col("l_discount") * 100).cast("string")
    raw = F.when(k == 0, F.concat(pct, F.lit("%"))).when(k == 1, pct).otherwise(F.lit("[•]"))
    return round_doubles(li.select("l_orderkey", "l_linenumber", C.parse_percentage(raw).alias("pct")))


@query("p6_date")
def p6_date(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    k = F.col("o_orderkey") % 6
    day = F.dayofmonth(d)
    raw = (F.when(k == 0, F.concat(day.cast("string"), _ordinal_suffix(day), F.lit(" "), F.date_format(d, "MMMM yyyy")))
           .when(k == 1, F.date_format(d, "d MMM yyyy"))
           .when(k == 2, F.date_format(d, "yyyy-MM-dd"))
           .when(k == 3, F.date_format(d, "dd/MM/yyyy"))
           .when(k == 4, F.date_format(d, "d-M-yyyy"))
           .otherwise(F.date_format(d, "MMMM d, yyyy")))
    return o.select("o_orderkey", C.parse_date(raw).alias("parsed"))


@query("p7_slug")
def p7_slug(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    raw = F.concat(F.lit(" "), F.col("p_name"), F.lit(" & Co.  Ltd. "), F.col("p_brand"))
    return p.select("p_partkey", C.company_slug(raw).alias("slug"))


@query("p9_listtext")
def p9_listtext(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    raw = F.when(F.col("p_partkey") % 4 == 0, F.lit("—")).otherwise(
        F.concat(F.lit("['"), F.col("p_name"), F.lit("',\n   '"), F.col("p_type"), F.lit("']  ")))
    return p.select("p_partkey", C.parse_listlike_text(raw).alias("objects"))


def listing_raw(spark, sf_dir) -> DataFrame:
    """An all-string 'raw section table' rendered from customer, with listing column names."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 4
    bal = F.format_number("c_acctbal", 2)
    return c.select(
        F.col("c_name").alias("company"),
        F.concat(F.lit("₹ "), bal, F.when(k == 0, F.lit(" Cr.")).otherwise(F.lit(""))).alias("issue_price"),
        F.when(k == 1, F.lit("[●]")).otherwise(bal).alias("net_worth"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit("%")).alias("allocation_qib"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit(".5")).alias("subscription_retail_investors"),
        F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), F.col("c_custkey").cast("int") % 1000),
                      "d MMMM yyyy").alias("open_date"),
        F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" ")).alias("exchange"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit("%")).alias("pre_issue_promoter_holding"),
    )


@query("p10_dispatch")
def p10_dispatch(spark, sf_dir):
    return round_doubles(C.clean_df(listing_raw(spark, sf_dir)))


@query("x1_text")
def x1_text(spark, sf_dir):
    pg = read_table(spark, sf_dir, "pages")
    t = X.html_text("html")
    return pg.select("page_id", t.alias("text"), F.length(t).alias("n_chars"))


@query("x1_references")
def x1_references(spark, sf_dir):
    """Numeric, hexadecimal, named and unknown references whose expected characters the row itself tells."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 90 + 33
    html = F.concat(F.lit("<p title='a>b'>"), F.col("p_name"), F.lit("&#"), k.cast("string"), F.lit(";&#x"),
                    F.lower(F.hex(k + 8352)), F.lit(";&rsquo;&amp;lt;&nbsp;&bogus;&#8377;</p><b>&frac12;</b>"))
    return p.select("p_partkey", X.html_text(html).alias("text"))


@query("x13_first_number")
def x13_first_number(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    raw = F.concat(F.lit("₹"), F.format_number("o_totalprice", 2), F.lit(" <img src='up.png'> (+"),
                   F.col("o_custkey").cast("string"), F.lit(")"))
    return round_doubles(o.select("o_orderkey", X.first_signed_decimal(raw).alias("gmp")))


# ---- fixed values: investor-category labels as printed on subscription pages ---------------
CATEGORY_LABELS = ["Anchor Investors", "QIB (Ex Anchor)", "Non-Institutional Buyers", "bNII (bids above ₹10L)",
                   "sNII (bids below ₹10L)", "Retail Investors", "Employees**", "Shareholders", "- Market Maker",
                   "Qualified Institutional Buyers (QIB)", "Retail Individual Investors (RIIs)",
                   "NII (HNI) above 10 lakh"]


@query("x19_category")
def x19_category(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    labels = F.array(*[F.lit(s) for s in CATEGORY_LABELS])
    raw = F.concat(F.element_at(labels, (F.col("c_custkey") % len(CATEGORY_LABELS) + 1).cast("int")),
                   F.lit(" "), F.when(F.col("c_custkey") % 2 == 0, F.lit("*")).otherwise(F.lit("")))
    return c.select("c_custkey", X.canonical_category(raw).alias("category_key"))


@query("x20_slugify")
def x20_slugify(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    raw = F.concat(F.col("c_name"), F.lit(" & "), F.col("c_mktsegment"), F.lit(" (₹10L)"))
    return c.select("c_custkey", X.slugify(raw).alias("slug"))


@query("x22_space")
def x22_space(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    raw = F.concat(F.lit("\t "), F.col("p_type"), F.lit(" \n\n  "), F.col("p_brand"), F.lit("   "))
    return p.select("p_partkey", C.collapse_ws(raw).alias("header"), X.norm_header(raw).alias("header_norm"))


@query("c5_url_id")
def c5_url_id(spark, sf_dir):
    pg = read_table(spark, sf_dir, "pages")
    return pg.select("page_id", U.url_numeric_id("url").alias("ipo_id"))


@query("c6_storage_key")
def c6_storage_key(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    return p.select("p_partkey", U.storage_key(F.concat(F.col("p_name"), F.lit(" "), F.col("p_brand"))).alias("key"))


@query("c8_json")
def c8_json(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.lit("events").alias("src"),
                                                     F.col("props").alias("body"))
    pg = read_table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.lit("pages").alias("src"),
                                                    F.col("html").alias("body"))
    return ev.unionByName(pg).select("id", "src", U.looks_like_json("body").alias("is_json"))


# ---------------------------------------------------------------------------------------------
# Extraction over section pages rendered from ``customer`` (X2-X25), layers
# ---------------------------------------------------------------------------------------------
from ..operators import extract as XT  # noqa: E402
from ..operators.layers import map_to_columns  # noqa: E402
from ..registry import Registry  # noqa: E402
from .fixtures import render_pages  # noqa: E402
from .gold import FEATURE_GROUPS  # noqa: E402
from .medallion import pages_to_silver  # noqa: E402


def _customers(spark, sf_dir) -> DataFrame:
    """The customer rows (small, often one row group), hash-partitioned so that rendering, parsing and
    extraction spread over all tasks."""
    # sized by the cluster's cores, not by bytes: each small customer row becomes ~5 large pages
    n = max(2 * spark.sparkContext.defaultParallelism, 1)
    return read_table(spark, sf_dir, "customer").repartition(n, "c_custkey")


def listing_pages(spark, sf_dir) -> DataFrame:
    """Section pages for every customer."""
    return render_pages(_customers(spark, sf_dir))


def _section(spark, sf_dir, s) -> DataFrame:
    return listing_pages(spark, sf_dir).where(F.col("section") == s)


@query("x5_financials")
def x5_financials(spark, sf_dir):
    return round_doubles(C.clean_df(XT.extract_financials(_section(spark, sf_dir, "financials"))))


@query("x3_labels")
def x3_labels(spark, sf_dir):
    """Labels that end in another label, repeated labels and labels without a value (given customers)."""
    c, n, b = F.col("c_custkey"), F.col("c_nationkey"), F.format_number(F.abs("c_acctbal"), 2)
    html = F.concat(
        F.lit("<p>Net Assets : 5</p><p>EV/EBITDA : 12.5</p><p>Adjusted PAT : 9</p><p>EBITDA of the year</p><p>EBITDA : "), n.cast("string"),
        F.when(c % 2 == 0, F.concat(F.lit("</p><p>Total Assets : ₹ "), b)).otherwise(F.lit("</p><p>Assets n/a")),
        F.lit("</p><p>EBITDA margin (%) 7.5</p><p>Revenue : ₹ "), b, F.lit("</p><p>Revenue : 1</p><p>EPS (₹) -"), n.cast("string"), F.lit("</p>"))
    pages = _customers(spark, sf_dir).select("c_custkey", html.alias("html"))
    return round_doubles(C.clean_df(XT.extract_financials(pages, key="c_custkey").select(
        "c_custkey", "assets", "ebitda", "ebitda_margin", "pat", "revenue", "eps", "ev_ebitda"), keep=["c_custkey"]))


@query("x6_performance")
def x6_performance(spark, sf_dir):
    return round_doubles(C.clean_df(XT.extract_performance(_section(spark, sf_dir, "performance_report"))))


@query("x7_x8_information")
def x7_x8_information(spark, sf_dir):
    raw = XT.extract_information(_section(spark, sf_dir, "ipo_information"))
    raw = raw.withColumn("n_objects", F.size("object_of_issue")) \
             .withColumn("object_of_issue", F.array_join("object_of_issue", " | "))
    return round_doubles(C.clean_df(raw, keep=["n_objects"]))


@query("x11_x15_gmp")
def x11_x15_gmp(spark, sf_dir):
    return round_doubles(C.clean_df(XT.extract_gmp(_section(spark, sf_dir, "gmp"))))


@query("x17_x18_subscription")
def x17_x18_subscription(spark, sf_dir):
    """A column for every category that is found on a page."""
    raw = XT.extract_subscription(_section(spark, sf_dir, "subscription"))
    return round_doubles(C.clean_df(map_to_columns(raw, "fields")))


@query("s7_discovered_keys")
def s7_discovered_keys(spark, sf_dir):
    raw = XT.extract_subscription(_section(spark, sf_dir, "subscription"))
    return raw.select(F.explode(F.map_keys("fields")).alias("field")).groupBy("field").agg(F.count("*").alias("pages"))


@query("c9_complete")
def c9_complete(spark, sf_dir):
    from ..operators.frontier import page_complete
    p = _section(spark, sf_dir, "subscription")
    return page_complete(p, key="company")


@query("x25_failures")
def x25_failures(spark, sf_dir):
    """Given pages, most of them cut off at a place that depends on the row: the quarantine and its counts."""
    k = F.col("page_id") % 5
    p = read_table(spark, sf_dir, "pages").select(
        "page_id", F.substring("html", F.lit(1), (F.length("html") * k / 4).cast("int")).alias("html"))
    s = XT.scan_pages(p, ["page_id"])
    return s.failures.withColumns({"n_pages": F.lit(s.n_pages).cast("long"), "n_failed": F.lit(s.n_failed).cast("long")})


@query("s14_silver")
def s14_silver(spark, sf_dir):
    return round_doubles(pages_to_silver(listing_pages(spark, sf_dir)))


@query("s11_s14_incremental")
def s11_s14_incremental(spark, sf_dir):
    """Two batches of pages, the second one the pages still pending; equal to one batch of all."""
    from . import incremental as INC
    root = scratch_path(spark, "layer")
    pages = listing_pages(spark, sf_dir)
    INC.add_pages(pages.where(F.crc32("company") % 3 != 0), root)
    INC.add_pages(INC.pending_pages(pages, root), root)
    return round_doubles(INC.silver_of(spark, root))


@query("g1_listing_gold")
def g1_listing_gold(spark, sf_dir):
    silver = pages_to_silver(listing_pages(spark, sf_dir))
    res = create_gold(silver, Registry().strategy_map(), FEATURE_GROUPS["custom"], keep=["company"])
    return round_doubles(res.features)


# ---------------------------------------------------------------------------------------------
# Aggregations, imputation, outliers, normalisation, artifacts
# ---------------------------------------------------------------------------------------------
import uuid  # noqa: E402

from ..operators import profile as PR  # noqa: E402
from ..operators.apply import handle_outliers, impute, normalize  # noqa: E402
from ..operators.fit import quantiles  # noqa: E402
from ..registry import (ColumnStrategy, ImputerPolicy, NormalizationPolicy,  # noqa: E402
                        OutlierPolicy)
from ..session import ensure_checkpoint_dir  # noqa: E402
from ..sources import io as IO  # noqa: E402

PROBS = [0.01, 0.25, 0.5, 0.75, 0.99]
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def scratch_path(spark, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint dir (never machine-local on a cluster)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("a1_a2_quantiles")
def a1_a2_quantiles(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    q = quantiles(li, LI_NUM, PROBS)
    entries = [F.struct(F.lit(c).alias("column"), F.lit(p).alias("prob"), F.col(c)[i].alias("value"))
               for c in LI_NUM for i, p in enumerate(PROBS)]
    return round_doubles(q.select(F.inline(F.array(*entries))))


@query("a6_profile")
def a6_profile(spark, sf_dir):
    return PR.profile(read_table(spark, sf_dir, "orders"))


@query("a6_profile_sketch")
def a6_profile_sketch(spark, sf_dir):
    """Sketches of the parts of a layer, merged; the estimate lies within four standard errors of the exact number."""
    o = read_table(spark, sf_dir, "orders")
    merged = PR.merge_profiles(PR.profile_sketch(o, ["o_orderpriority"]))
    exact = PR.profile(o).select("column", F.col("distinct").alias("exact"))
    error = 4 * 1.04 / 2 ** (PR.SKETCH_LG_K / 2)
    return merged.join(exact, "column").select("column", "non_null", "nulls", (
        F.abs(F.col("distinct") - F.col("exact")) <= F.ceil(error * F.col("exact"))).alias("within"))


@query("a7_describe")
def a7_describe(spark, sf_dir):
    return round_doubles(PR.describe(read_table(spark, sf_dir, "lineitem"), LI_NUM))


EVENTS_STRATEGIES = {
    "value": ColumnStrategy(ImputerPolicy.MEDIAN_WITH_MISSING_INDICATOR),
    "k": ColumnStrategy(ImputerPolicy.ZERO_WITH_MISSING_INDICATOR),
    "user_id": ColumnStrategy(ImputerPolicy.MEDIAN),
}


def events_with_gaps(spark, sf_dir) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.when(F.col("event_id") % 7 == 0, None).otherwise(F.col("value")).alias("value"),
        F.when(F.col("event_type") == "error", None).otherwise(F.get_json_object("props", "$.k")).alias("k"),
        F.when(F.col("event_id") % 5 == 0, None).otherwise(F.col("user_id")).alias("user_id"))


@query("i1_i4_impute")
def i1_i4_impute(spark, sf_dir):
    src = events_with_gaps(spark, sf_dir)
    art = fit(src, EVENTS_STRATEGIES)
    out = impute(src, art, list(EVENTS_STRATEGIES))
    return round_doubles(out.select("event_id", "value", "k", "user_id", "k__is_missing", "value__is_missing"))


@query("i6_fill_zero")
def i6_fill_zero(spark, sf_dir):
    src = events_with_gaps(spark, sf_dir).withColumn("k", F.col("k").cast("double"))
    return round_doubles(src.fillna(0, subset=["value", "k", "user_id"]))


ORDERS_OUTLIER = {
    "o_totalprice": ColumnStrategy(outlier=OutlierPolicy.PCTL_CLIP, pctl_low=0.05, pctl_high=0.95),
    "o_custkey": ColumnStrategy(outlier=OutlierPolicy.IQR_FILTER, iqr_k=0.5),
    "o_shippriority": ColumnStrategy(outlier=OutlierPolicy.CLIP_THEN_PCTL_CLIP, hard_min=2.0, hard_max=4.0),
}


def orders_for_outliers(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_totalprice", "o_custkey",
                    F.substring("o_orderpriority", 1, 1).cast("int").alias("o_shippriority"))


@query("o2_o4_clip")
def o2_o4_clip(spark, sf_dir):
    src = orders_for_outliers(spark, sf_dir)
    art = fit(src, ORDERS_OUTLIER)
    return round_doubles(handle_outliers(src, art, list(ORDERS_OUTLIER), mode="clip")
                         .select("o_orderkey", *ORDERS_OUTLIER))


@query("o5_o6_drop_orders")
def o5_o6_drop_orders(spark, sf_dir):
    src = orders_for_outliers(spark, sf_dir)
    art = fit(src, ORDERS_OUTLIER)
    return round_doubles(handle_outliers(src, art, list(ORDERS_OUTLIER), mode="drop")
                         .select("o_orderkey", *ORDERS_OUTLIER))


CUSTOMER_NORM = {
    "acct_log": ColumnStrategy(normalization=NormalizationPolicy.LOG1P),
    "acct_robust": ColumnStrategy(normalization=NormalizationPolicy.ROBUST_Z),
    "acct_minmax": ColumnStrategy(normalization=NormalizationPolicy.MINMAX),
}


@query("z1_z7_normalize")
def z1_z7_normalize(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    src = c.select("c_custkey", *[F.col("c_acctbal").alias(n) for n in CUSTOMER_NORM])
    art = fit(src, CUSTOMER_NORM)
    return round_doubles(normalize(src, art, list(CUSTOMER_NORM)))


@query("s12_artifacts")
def s12_artifacts(spark, sf_dir):
    src = lineitem_with_gaps(spark, sf_dir)
    path = scratch_path(spark, "artifacts")
    IO.save_artifacts(fit(src, LINEITEM_STRATEGIES, LINEITEM_COLS), path)
    return round_doubles(IO.load_artifacts(spark, path))


@query("q5_iqr_filter")
def q5_iqr_filter(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return round_doubles(PR.iqr_filter(li, "l_quantity", factor=0.5))


@query("q6_pctl_filter")
def q6_pctl_filter(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return round_doubles(PR.percentile_filter(li, "l_extendedprice", 0.01, 0.99))


@query("q7_sequential_iqr")
def q7_sequential_iqr(spark, sf_dir):
    src = lineitem_with_gaps(spark, sf_dir)
    return round_doubles(PR.sequential_iqr_filter(src, LI_NUM, factor=1.0))


@query("m1_spearman")
def m1_spearman(spark, sf_dir):
    return round_doubles(PR.spearman(lineitem_with_gaps(spark, sf_dir), LI_NUM))


@query("m2_weak_correlation")
def m2_weak_correlation(spark, sf_dir):
    return PR.weak_correlation(PR.spearman(lineitem_with_gaps(spark, sf_dir), LI_NUM), 0.2)


@query("m3_standardize")
def m3_standardize(spark, sf_dir):
    return round_doubles(PR.standardize(read_table(spark, sf_dir, "lineitem"), LI_NUM))


@query("m4_a9_pca_variance")
def m4_a9_pca_variance(spark, sf_dir):
    var, _ = PR.pca(read_table(spark, sf_dir, "lineitem"), LI_NUM)
    return round_doubles(var)


@query("m4_m5_pca_correlation")
def m4_m5_pca_correlation(spark, sf_dir):
    """The components put together again: k * sum(ratio * loading_a * loading_b) is the correlation matrix."""
    var, load = PR.pca(read_table(spark, sf_dir, "lineitem"), LI_NUM)
    other = load.select(F.col("feature").alias("col_j"), "pc", F.col("loading").alias("l_j"))
    return round_doubles(load.join(other, "pc").join(var, "pc").groupBy(F.col("feature").alias("col_i"), "col_j")
                         .agg((F.sum(F.col("explained_ratio") * F.col("loading") * F.col("l_j")) * len(LI_NUM)).alias("corr"),
                              F.max("cumulative").alias("all_ratios")))


@query("m5_m6_importance")
def m5_m6_importance(spark, sf_dir):
    var, load = PR.pca(read_table(spark, sf_dir, "lineitem"), LI_NUM)
    return round_doubles(PR.importance(var, load))


# ---------------------------------------------------------------------------------------------
# Projection, joins, unions, dedup
# ---------------------------------------------------------------------------------------------
from ..operators.layers import coalesce_clashes, dedup_first, join_chain, preview, project, resolve_clashes, union_all  # noqa: E402,E501


def _chain_tables(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                                      F.col("c_acctbal").alias("bal"), "c_mktsegment")
    o = read_table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), "o_orderkey",
                                                    F.col("o_totalprice").alias("bal"), "o_orderstatus")
    s = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
                                                      F.col("s_acctbal").alias("bal"))
    return [c, o, s]


@query("j1_join_chain")
def j1_join_chain(spark, sf_dir):
    return round_doubles(join_chain(_chain_tables(spark, sf_dir), ["key"]))


@query("j2_resolve")
def j2_resolve(spark, sf_dir):
    joined = join_chain(_chain_tables(spark, sf_dir), ["key"])
    out = resolve_clashes(joined, drop=["bal_x"], rename={"bal_y": "order_total"})
    return round_doubles(coalesce_clashes(out, ["name"], prefer="_y", other="_x"))


def _two_projections(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    a = o.select("o_orderkey", "o_custkey", "o_totalprice")
    b = o.select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority", "o_custkey")
    return a, b


@query("u1_s7_union")
def u1_s7_union(spark, sf_dir):
    return round_doubles(union_all(list(_two_projections(spark, sf_dir))))


@query("a5_u2_dedup")
def a5_u2_dedup(spark, sf_dir):
    u = union_all(list(_two_projections(spark, sf_dir)))
    return round_doubles(dedup_first(u, ["o_custkey"], order=["o_orderkey"]))


@query("q1_q3_projection")
def q1_q3_projection(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    p = project(o, ["o_orderkey", "ipo_size", "o_totalprice", "o_orderstatus", "not_there"])
    return round_doubles(resolve_clashes(p, drop=["o_orderstatus"], rename={"o_totalprice": "total"}))


# ---------------------------------------------------------------------------------------------
# Crawl work-list (C1-C4, C7) and I/O round trips
# ---------------------------------------------------------------------------------------------
from ..operators import frontier as FR  # noqa: E402

BASE_URL = "https://listings.example"


@query("c1_manifest")
def c1_manifest(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    c = c.withColumn("segment", F.when(F.col("c_mktsegment").isin("BUILDING", "FURNITURE"), "sme").otherwise("mainboard"))
    counts = FR.pages_needed(c, ["c_mktsegment", "segment"], page_size=10)
    return FR.page_manifest(counts, "n_pages", BASE_URL + "/main-board/index",
                            cache_buster_ms=1_700_000_000_000, keys=["c_mktsegment", "segment"], segment="segment")


def _list_rows(spark, sf_dir) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    slug = F.lower(F.regexp_replace("c_name", "#", "-"))
    gain = F.when(F.col("c_custkey") % 3 == 0, None).otherwise(
        F.concat(F.lit(BASE_URL + "/gmp/"), slug, F.lit("/"), F.col("c_custkey").cast("string"), F.lit("/")))
    return c.select(F.col("c_custkey").alias("id"), F.concat(F.col("c_name"), F.lit(" Ltd")).alias("company_name"),
                    slug.alias("slug"), gain.alias("investor_gain"), "c_mktsegment")


@query("c2_c4_fanout")
def c2_c4_fanout(spark, sf_dir):
    f = FR.fan_out(_list_rows(spark, sf_dir), BASE_URL)
    return f.select("company", "section", "url", FR.route("url").alias("handler"))


@query("c3_pending")
def c3_pending(spark, sf_dir):
    frontier = FR.fan_out(_list_rows(spark, sf_dir), BASE_URL)
    fetched = listing_pages(spark, sf_dir).select(
        F.regexp_replace("company", "_", "#").alias("c"), "section")
    fetched = fetched.select(F.concat(F.col("c"), F.lit("_ltd")).alias("company"), "section")
    return FR.pending(frontier, fetched, ["company", "section"]).select("company", "section")


@query("c7_status")
def c7_status(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    status = (F.when(F.col("event_type") == "error", 503).when(F.col("event_type") == "click", 429)
              .when(F.col("event_type") == "signup", 404).otherwise(200))
    body = F.when(F.get_json_object("props", "$.k").cast("int") % 10 == 0,
                  F.lit('{"msg": 0, "error": "blocked"}')).otherwise(F.col("props"))
    log = ev.select("event_id", status.alias("status"), body.alias("body"))
    return log.select("event_id", "status", FR.classify_response("status", "body", success_key="k").alias("outcome"))


@query("s8_payload")
def s8_payload(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    pages = (o.groupBy((F.col("o_orderkey") / 10).cast("long").alias("page"))
             .agg(F.to_json(F.struct(F.collect_list(F.struct("o_orderkey", "o_custkey", "o_orderstatus"))
                                     .alias("data"))).alias("payload")))
    return IO.parse_payload(pages, "payload", "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING",
                            fields=["o_orderkey", "o_orderstatus", "missing_field"])


@query("s4_s6_csv_roundtrip")
def s4_s6_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "d MMMM yyyy").alias("o_orderdate"),
        "o_orderpriority")
    IO.write_csv(o, path)
    raw = IO.read_csv_text(spark, path)
    typed = raw.select(C.parse_number("o_orderkey").cast("long").alias("o_orderkey"),
                       C.parse_number("o_totalprice").alias("o_totalprice"),
                       C.parse_date("o_orderdate").alias("o_orderdate"), C.parse_text("o_orderpriority").alias("o_orderpriority"))
    return round_doubles(typed)


@query("s5_typed")
def s5_typed(spark, sf_dir):
    """Typed CSV with quotes and line ends inside values, and records whose price is no number."""
    path = scratch_path(spark, "typed")
    k = F.col("o_orderkey")
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(k % 7 == 0, "not known").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(k % 3 == 0, F.concat(F.lit('say "'), "o_orderpriority", F.lit('",\nthen stop'))).otherwise(F.col("o_orderpriority")).alias("note"))
    IO.write_csv(o, path)
    t = IO.read_csv_typed(spark, path, "o_orderkey long, o_totalprice double, note string")
    return round_doubles(t.select("o_orderkey", "o_totalprice", "note", F.col(IO.REJECT).isNotNull().alias("rejected")))


@query("s10_base_table")
def s10_base_table(spark, sf_dir):
    """One base table, partitioned by segment, written and read back."""
    path = scratch_path(spark, "base")
    c = read_table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("segment"), "c_custkey", "c_name", "c_acctbal")
    IO.write_table(c, path, ["segment"])
    return round_doubles(spark.read.parquet(path).select("segment", "c_custkey", "c_name", "c_acctbal"))


@query("q9_preview")
def q9_preview(spark, sf_dir):
    return round_doubles(preview(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"),
                                 20, ["o_orderpriority", "o_totalprice"]))


@query("f4_override")
def f4_override(spark, sf_dir):
    """the same columns under overridden cleaners: a share read as a number, an amount kept as text."""
    raw = listing_raw(spark, sf_dir).select("company", "issue_price", "net_worth", "allocation_qib", "pre_issue_promoter_holding")
    return round_doubles(C.clean_df(raw, overrides={"allocation_qib": "text", "net_worth": "text", "issue_price": "number", "company": "text"}))


@query("g2_groups")
def g2_groups(spark, sf_dir):
    """Every feature group from one shared fit, long form (group, company, feature, value or label)."""
    from .gold import create_gold_groups
    silver = pages_to_silver(listing_pages(spark, sf_dir))
    frames, _ = create_gold_groups(silver, Registry().strategy_map(), FEATURE_GROUPS, keep=["company"])
    parts = []
    for g, df in frames.items():
        entries = []
        for f in [c for c in df.columns if c != "company"]:
            number = df.schema[f].dataType.typeName() not in ("string", "date")
            entries.append(F.struct(F.lit(f).alias("feature"),
                                    (F.col(f) if number else F.lit(None)).cast("double").alias("value"),
                                    (F.lit(None) if number else F.col(f)).cast("string").alias("label")))
        parts.append(df.select(F.lit(g).alias("group"), "company", F.inline(F.array(*entries))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return round_doubles(out)
