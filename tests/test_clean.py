"""Scalar cleaning cases (FIXTURES.md section 3) and properties of the cleaners."""
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions import clean as C
from quarry.functions import text as X
from quarry.functions import url as U


def _one(spark, fn, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_placeholders_become_null(spark):
    vals = ["[●]", "[•]", "—", "-", "NA", "N/A", "null", "None", "", "  ", "n/a", " 12 "]
    assert _one(spark, C.missing_to_null, vals) == [None] * 10 + ["n/a", "12"]


def test_money_to_crore(spark):
    vals = ["₹ 356.19 Cr.", "₹ 6,997.28 Cr.", "₹ 25.5 Lakh", "1,617.30", "473.80", "[●]", "abc"]
    assert _one(spark, C.parse_money_crore, vals) == [356.19, 6997.28, 0.255, 1617.3, 473.8, None, None]


def test_number(spark):
    assert _one(spark, C.parse_number, ["1,617.30", "-3.20", "4", "abc", "NA", "nan"]) == \
        [1617.3, -3.2, 4.0, None, None, None]


def test_percent(spark):
    assert _one(spark, C.parse_percentage, ["100%", "7.14%", "0.43", "74.5 %", "—"]) == [100.0, 7.14, 0.43, 74.5, None]


def test_dates(spark):
    vals = ["31st March 2015", "31 Mar 2015", "2015-03-31", "31/03/2015", "31-03-2015", "March 31, 2015", "x"]
    d = dt.date(2015, 3, 31)
    assert _one(spark, C.parse_date, vals) == [d] * 6 + [None]


def test_company_slug_and_category_slug(spark):
    assert _one(spark, C.company_slug, ["A & B  Ltd.", "  ", "Ünïcode Co"]) == ["a_b_ltd", None, "n_code_co"]
    assert _one(spark, X.slugify, ["bNII (bids above ₹10L)"]) == ["bnii_bids_above_10l"]


def test_category_canonicaliser(spark):
    labels = ["Anchor Investors", "QIB (Ex Anchor)", "Non-Institutional Buyers", "bNII (bids above ₹10L)",
              "- sNII (bids below ₹10L)", "Retail Investors", "Employees**", "Shareholders"]
    assert _one(spark, X.canonical_category, labels) == [
        "anchor_investors", "qib_ex_anchor", "non_institutional_buyers", "bnii_bids_above_10l",
        "snii_bids_below_10l", "retail_investors", "employees", "shareholders"]


def test_url_id(spark):
    urls = ["https://x.example/ipo/abc-ltd/1234/", "https://x.example/gmp/abc/99?x=1", "https://x.example/a/b",
            "https://x.example/a/b77"]
    assert _one(spark, U.url_numeric_id, urls) == ["1234", "99", None, "77"]


def test_visible_text(spark):
    html = "<!DOCTYPE html><html><head><style>p{}</style><script>var t='</p>';</script></head>" \
           "<body><!-- c --><p>A&nbsp;&amp;&nbsp;B</p><p>C &copy; D</p></body></html>"
    assert _one(spark, X.html_text, [html]) == ["A & B C © D"]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(max_size=20), min_size=1, max_size=8))
def test_cleaners_are_total_and_slug_idempotent(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    out = df.select(C.parse_number("x").alias("n"), C.parse_percentage("x").alias("p"),
                    C.parse_money_crore("x").alias("m"), C.parse_date("x").alias("d"),
                    C.company_slug("x").alias("s")).collect()
    slugs = [r["s"] for r in out]
    again = _one(spark, C.company_slug, slugs)
    assert again == slugs


def test_only_finite_plain_numbers(spark):
    rows = [("1,617.30", 1617.3), ("-3.", -3.0), (".5", 0.5), ("2e3", 2000.0), ("1d", None), ("5f", None), ("inf", None),
            ("-Infinity", None), ("NaN", None), ("1e400", None), ("", None)]
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(rows)], "i int, s string")
    for parse in (C.parse_number, C.parse_percentage, C.parse_money_crore):
        got = [r[0] for r in df.orderBy("i").select(parse(df["s"])).collect()]
        assert got == [v for _, v in rows]
