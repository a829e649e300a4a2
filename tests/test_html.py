"""Golden pages for the structure scan and the section extractors."""
import pytest
from pyspark.sql import functions as F

from quarry.functions.text import html_text
from quarry.operators import extract as XT
from quarry.operators import html as H
from quarry.operators.frontier import page_complete

GMP = """<html><body><table><thead><tr><th>GMP Date</th><th>GMP</th></tr></thead><tbody>
<tr><td>01 <span class='badge'>Open</span></td><td>₹999</td></tr></tbody></table>
<h2>IPO GMP Trend</h2><table><thead><tr><th>GMP</th><th>GMP Date</th></tr></thead><tbody>
<tr><td>₹55 <img src=x></td><td>10-12 <span class="badge bg-success">Open</span></td></tr>
<tr><td>--</td><td>11-12 <span class='badge'>Close</span></td></tr>
<tr><td>₹-3</td><td>12-12 Close</td></tr>
<tr><td>₹1,200</td><td>13-12 <div class='badge'>Listing</div></td></tr>
</tbody></table></body></html>"""

SUB = """<table><tr><td colspan=2>Day 3</td></tr><tr><th>Category</th><th>Subscription (times)</th></tr>
<tr><td>Anchor Investors</td><td>1</td></tr><tr><td>QIB (Ex Anchor)</td><td>1.06</td></tr>
<tr><td>Employees**</td><td>2</td></tr><tr><td>Employees**</td><td>3</td></tr><tr><td>Total</td><td>9</td></tr></table>
<table><tr><th>Category</th><th>Size (%)</th></tr><tr><td>Total IPO Subscription</td><td>100%</td></tr></table>"""

OBJ = "<h3>Objects of the Issue</h3><p>Net proceeds are used for:</p><ul>" + \
      "".join(f"<li>Object number {i}</li>" for i in range(12)) + "</ul>"


def tables(spark, html):
    df = spark.createDataFrame([(html,)], "html string").select(H.parse_page("html").alias("p"))
    return df.select(H.tables_of(F.col("p"), "text", "flat", "badges").alias("t"),
                     F.transform("p.headings", lambda h: H.heading_text(F.col("p"), h)).alias("h")).first()


def test_parse_tables_and_badges(spark):
    r = tables(spark, GMP)
    assert len(r.t) == 2
    cell = r.t[1].rows[1].cells[1]
    assert cell.badges == ["Open"] and cell.text == "10-12 Open"
    assert [x.group for x in r.t[1].rows][:2] == ["thead", "tbody"] and r.h == ["IPO GMP Trend"]


def test_broken_page_does_not_fail(spark):
    r = tables(spark, "<p>unclosed <b>bold <table><tr><td>x")
    assert r.t[0].rows[0].cells[0].text == "x"
    nested = tables(spark, "<table><thead><tr><th>a<table><tbody><tr><td>in</table></thead><tr><td>b</table>")
    assert [[(x.group, x.group_no, [c.flat for c in x.cells]) for x in t.rows] for t in nested.t] == [
        [("thead", 0, ["ain", "in"]), ("thead", 0, ["in"]), ("", 0, ["b"])], [("tbody", 0, ["in"])]]


def test_scan_is_linear():
    """Deep, unclosed and stray tags: no recursion, and the index holds each element once."""
    sizes = {}
    for n in (1000, 4000):
        pages = ["<table><tr><td>1</td></tr></table>" + "<p>" * n + "x", "".join(f"<b>w{i}</b> text" for i in range(n)),
                 "<b>word " * n, "<b>" * n + "x" + "</i>" * n, "<table><tr><td>x" * n, "<ul><li><b>h</b>y" * n]
        scans = [H.scan_html(p) for p in pages]
        assert all(s["error"] is None for s in scans) and len(scans[0]["tables"]) == 1 and len(scans[1]["headings"]) == n
        sizes[n] = [sum(len(v) for v in s.values() if v) for s in scans]
    assert all(b <= 4 * a + 10 for a, b in zip(sizes[1000], sizes[4000]))


def test_selectors():
    html = "<nav>Home</nav><div class='x panel-box' id=p><table><tr><td>a</td></tr><thead><tr><th>h</table></div><table><tr><td>b"
    s = H._Select([H.compile_selector(x) for x in ("div.panel-box table tbody tr", "#p", "table td", ".x tr", "div div")]).run(html)
    assert [[s.strings[h["a"]:h["b"]] for h in hits] for hits in s.hits] == [[["a"]], [["a", "h"]], [["a"], ["b"]], [["a"], ["h"]], []]
    with pytest.raises(ValueError):
        H.compile_selector("div > p")


def test_page_complete_reads_the_panel_only(spark):
    box = "<div class='panel-box'>"
    rows = [("menu", "<nav>Home</nav>", False), ("none", None, False), ("wait", f"<nav>Home</nav>{box}Status: [●]</div>", False),
            ("text", f"{box}Closed</div>", True), ("table", f"{box}[●]<table><tr><td>1</td></tr></table></div>", True),
            ("head", f"{box}[●]<table><thead><tr><th>Category</th></tr></thead></table></div>", False),
            ("blank", f"{box}[●]<table><tr><td> </td></tr></table></div>", False),
            ("else", f"<table><tr><td>1</td></tr></table>{box}[●]</div>", False)]
    df = spark.createDataFrame([r[:2] for r in rows], "company string, html string")
    assert {r.company: r.complete for r in page_complete(df).collect()} == {r[0]: r[2] for r in rows}


def test_failures_stand_beside_the_records(spark):
    rows = [("a", SUB), ("b", None), ("c", "  "), ("d", "<html><body>" + SUB), ("e", SUB + "<td"), ("f", "<html>" + SUB + "</html>")]
    s = XT.scan_pages(spark.createDataFrame(rows, "company string, html string"), ["company"])
    assert {r.company: r.error for r in s.failures.collect()} == {
        "b": "no content", "c": "no content", "d": "no end of page", "e": "cut inside a tag"}
    assert (s.n_pages, s.n_failed) == (6, 4)
    got = {r.company: r.fields for r in XT.extract_subscription(s.pages).collect()}
    assert set(got) == {"a", "f"} and got["a"] == got["f"] and got["a"]["subscription_employees"] == "3"


def test_references(spark):
    cases = {"<p>&#8377; 5 &rsquo;s</p>": "₹ 5 ’s", "<a title=\"b>k\">x</a>": "x", "5 < 6 &amp;lt; &bogus; &#150;&#xD800;": "5 < 6 &lt; &bogus; –\ufffd",
             "<script>if(a<b){'</p>'}</script>t": "t", "<a title=\"x>y": "y", "a&nbsp;\n&#160;b": "a b", "": ""}
    df = spark.createDataFrame([(k,) for k in cases], "s string").select("s", html_text("s").alias("t"))
    assert {r.s: r.t for r in df.collect()} == cases


def test_labels_that_end_in_others(spark):
    df = spark.createDataFrame([("a", "<p>Net Assets : 5</p><p>EV/EBITDA : 12.5</p><p>Total Revenue : none</p><p>Revenue : 7</p>"),
                                ("b", "<p>EBITDA margin (%) 12 EBITDA : 3 EV / EBITDA (times) : 4 EBITDA : 5</p>")], "company string, html string")
    r = {x.company: x for x in XT.extract_financials(df).collect()}
    assert (r["a"].assets, r["a"].ebitda, r["a"].ev_ebitda, r["a"].revenue) == (None, None, None, "7")
    assert (r["b"].ebitda_margin, r["b"].ebitda, r["b"].ev_ebitda) == ("12", "3", "4")


def test_gmp_extraction(spark):
    df = spark.createDataFrame([("a", GMP)], "company string, html string")
    r = XT.extract_gmp(df).first()
    assert (r.ipo_open_gmp, r.ipo_close_gmp, r.ipo_allotment_gmp, r.ipo_listing_gmp) == ("55", "-3", None, "1200")


def test_subscription_extraction(spark):
    df = spark.createDataFrame([("a", SUB)], "company string, html string")
    fields = XT.extract_subscription(df).first().fields
    assert fields == {"subscription_anchor_investors": "1", "subscription_qib_ex_anchor": "1.06",
                      "subscription_employees": "3", "allocation_total_ipo_subscription": "100%"}


def test_objects_all_kept(spark):
    df = spark.createDataFrame([("a", OBJ)], "company string, html string")
    objs = XT.extract_information(df).first().object_of_issue
    assert objs == ["Net proceeds are used for:"] + [f"Object number {i}" for i in range(12)]


def test_financial_table_fallback(spark):
    html = ("<table><tr><td>PAT Margin [%]</td><td>3.5</td></tr><tr><td>Net Worth [x]</td><td>1</td></tr>"
            "<tr><td>Net Worth [y]</td><td>2</td></tr></table>")
    df = spark.createDataFrame([("a", html), ("b", "<p>Net Worth : ₹ 5</p><p>EBITDA margin (%) 12.5</p>")],
                               "company string, html string")
    rows = {r.company: r for r in XT.extract_financials(df).collect()}
    assert rows["a"].pat_margin == "3.5" and rows["a"].pat is None and rows["a"].net_worth == "2"
    assert rows["b"].net_worth == "5" and rows["b"].ebitda_margin == "12.5" and rows["b"].ebitda is None


def test_header_row_far_down(spark):
    html = "<table>" + "<tr><td>note</td></tr>" * 8 + SUB[SUB.index("<table") + 7:].split(">", 1)[1]
    df = spark.createDataFrame([("a", SUB), ("b", html)], "company string, html string")
    rows = {r.company: r.fields for r in XT.extract_subscription(df).collect()}
    assert rows["b"] == rows["a"]
