"""Section pages rendered from the provided ``customer`` table.

The provided ``pages`` table has no tables or section templates, so extraction
queries render one page per (customer, section) with Spark string functions.
Every value on a page is a function of the customer row, so the oracle can
select the expected fields straight from ``customer``.  The templates cover the
golden cases: inline text, table-only financials, parenthesised units, reordered
GMP columns with badges, a header row that is not the first row, placeholder
cells, duplicate categories, totals and a page without a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECTIONS = ["financials", "gmp", "ipo_information", "performance_report", "subscription"]


def _s(x: Column, fmt: str = "%.2f") -> Column:
    return F.format_string(fmt, x.cast("double"))


def _num(x: Column, d: int = 2) -> Column:
    return F.format_number(x, d)


def _ordinal_date(d: Column) -> Column:
    day = F.dayofmonth(d)
    sfx = (F.when(day.isin(1, 21, 31), "st").when(day.isin(2, 22), "nd")
           .when(day.isin(3, 23), "rd").otherwise("th"))
    return F.concat(day.cast("string"), sfx, F.lit(" "), F.date_format(d, "MMMM yyyy"))


def _row(*cells: Column | str, tag: str = "td") -> Column:
    parts: list[Column] = [F.lit("<tr>")]
    for c in cells:
        parts += [F.lit(f"<{tag}>"), c if isinstance(c, Column) else F.lit(c), F.lit(f"</{tag}>")]
    parts.append(F.lit("</tr>"))
    return F.concat(*parts)


def _page(title: Column, *body: Column) -> Column:
    return F.concat(F.lit("<!DOCTYPE html><html><head><meta charset='utf-8'><title>"), title,
                    F.lit("</title><script>var x = '</p>';</script></head><body><nav>Home &middot; IPO</nav>"),
                    *body, F.lit("<footer>&copy; listings</footer></body></html>"))


def company_key(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, "#", "_"))


def render_pages(customer: DataFrame, sections: list[str] | None = None) -> DataFrame:
    """(segment, section, company, html): one page per customer row and section.

    One union branch per section, so a later ``section = ...`` filter prunes the
    other branches at optimisation time.
    """
    c, n, b = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_acctbal")
    ab = F.abs(b)
    name = company_key(F.col("c_name"))
    seg = F.when(c % 2 == 0, "mainboard").otherwise("sme")

    fin_text = F.concat(
        F.lit("<h2>Financial Information</h2><div class='fin'>"),
        F.lit("<p>Total Assets : ₹ "), _num(ab + 1000), F.lit("</p><p>Net Worth : ₹ "), _num(ab),
        F.lit("</p><p>Total Debt : "), _s(n * 10 + 0.5), F.lit("</p><p>Total Revenue : ₹ "), _num(ab * 2),
        F.lit("</p><p>EBITDA : ₹ "), _s(c % 500 + 0.75), F.lit("</p><p>PAT : ₹ "), _s(c % 300 + 0.5),
        F.lit("</p><p>EBITDA margin (%) "), _s(n + 0.5), F.lit("</p><p>PAT margin (%) "), _s(n + 0.25),
        F.lit("</p><p>EPS (₹) "), _s(b / 100, "%.4f"), F.lit("</p><p>ROE (%) "), _s(n - 9.5),
        F.lit("</p><p>ROCE (%) "), _s(n * 2), F.lit("</p><p>ROA (%) "), _s(n / 4),
        F.lit("</p><p>Debt to Equity (x) "), _s(n / 10), F.lit("</p><p>Market Capitalisation : ₹ "), _num(ab * 3),
        F.lit("</p><p>EV/EBITDA (times) : "), _s(c % 40 + 0.5), F.lit("</p><p>P/B (times) : "), _s(n / 5),
        F.lit("</p><p>NAV (₹) : "), _s(b / 10, "%.3f"),
        F.lit("</p><p>Enterprise Value (EV) (₹ Cr.) : "), _num(ab + 500),
        F.lit("</p><p>PE Multiple (times) : "), _s(c % 60 + 0.5), F.lit("</p></div>"))
    fin_table = F.concat(
        F.lit("<h2>Financials</h2><table class='fin'>"), _row("Particulars", "Amount", tag="th"),
        _row("Net Worth [Rs Cr]", _num(ab)), _row("PAT Margin [%]", _s(n + 0.25)),
        _row("EBITDA Margin [%]", _s(n + 0.5)), _row("PAT [Rs Cr]", _s(c % 300 + 0.5)),
        _row("Total Revenue [Rs Cr]", _num(ab * 2)), _row("Debt to equity [x]", _s(n / 10)),
        _row("Net Worth [restated]", _num(ab + 1)), F.lit("</table>"))
    financials = _page(F.concat(name, F.lit(" financials")), F.when(c % 3 == 0, fin_table).otherwise(fin_text))

    trend = F.concat(
        F.lit("<table class='decoy'><thead>"), _row("GMP Date", "GMP", tag="th"), F.lit("</thead><tbody>"),
        _row(F.lit("01-01-2025 <span class='badge'>Open</span>"), F.lit("₹999")), F.lit("</tbody></table>"),
        F.lit("<h2>IPO Day-wise GMP Trend</h2><table><thead>"),
        _row("GMP", "Sub2 Sauda", "GMP Date", "Kostak", tag="th"), F.lit("</thead><tbody>"),
        _row(F.concat(F.lit("₹"), n.cast("string"), F.lit(" <img src='up.png'>")), F.lit("1200"),
             F.lit("10-12-2025 <span class=\"badge bg-success\">Open</span>"), F.lit("–")),
        _row("--", "–", "11-12-2025 <span class='badge'>Close</span>", "–"),
        _row(F.concat(F.lit("₹"), (c % 100 - 50).cast("string")), F.lit("–"), F.lit("12-12-2025 Close"), F.lit("–")),
        _row(F.lit("₹7"), F.lit("–"), F.lit("13-12-2025 <span class='badge'>Open</span>"), F.lit("–")),
        _row(F.concat(F.lit("₹"), _num(ab)), F.lit("–"), F.lit("15-12-2025 <div class='badge'>Allotment</div>"),
             F.lit("–")),
        _row(F.concat(F.lit("₹ "), _num(c * 10, 0)), F.lit("–"),
             F.lit("17-12-2025 <span class='badge'>Listing</span>"), F.lit("–")),
        F.lit("</tbody></table>"))
    headers_only = F.concat(
        F.lit("<table><thead>"), _row("GMP Date", "IPO Price", "GMP", tag="th"), F.lit("</thead><tbody>"),
        _row(F.lit("10-12-2025 <span class='badge'>Open</span>"), F.lit("100"), F.concat(F.lit("₹"), n.cast("string"))),
        _row(F.lit("12-12-2025 <span class='badge'>Close</span>"), F.lit("100"),
             F.concat(F.lit("₹"), (c % 100 - 50).cast("string"))),
        F.lit("</tbody></table>"))
    gmp = _page(F.concat(name, F.lit(" gmp")), F.when(c % 2 == 0, trend).otherwise(headers_only))

    base = F.date_add(F.lit("2020-01-01").cast("date"), (c % 1000).cast("int"))
    objects = F.concat(
        F.lit("<h2>Key Objects</h2><p>Decoy paragraph that is long enough.</p>"),
        F.lit("<h3>Objects of the Issue</h3><p>The net proceeds will be used for:</p><ul>"),
        F.concat(*[F.concat(F.lit(f"<li>Item {i}: capex for "), name, F.lit("</li>")) for i in range(1, 13)]),
        F.lit("</ul>"))
    info = _page(
        F.concat(name, F.lit(" information")),
        F.lit("<div class='info'><p>IPO Category : "), F.when(c % 2 == 0, "Mainboard").otherwise("SME"),
        F.lit("</p><p>Exchange : "), F.when(c % 2 == 0, "BSE, NSE").otherwise("NSE SME"),
        F.lit("</p><p>Issue Type : "), F.when(c % 3 == 0, "Fixed Price").otherwise("Book Built"),
        F.lit("</p><p>Issue Price : ₹ "), _num(ab), F.lit("</p><p>Market Capitalisation : ₹ "), _num(ab * 3),
        F.lit(" Cr.</p><p>PE multiple : "), _s(c % 60 + 1.5), F.lit("</p><p>Subscription : "), _s((c % 400) / 4.0),
        F.lit(" times</p><p>Pre Issue Promoter Holding : "), _s(n * 3 + 0.5, "%.1f"),
        F.lit("%</p><p>Post Issue Promoter Holding : "), _s(n * 2 + 0.5, "%.1f"),
        F.lit("%</p><p>Date of DRHP : "), _ordinal_date(F.date_sub(base, 60)),
        F.lit("</p><p>IPO Open Date : "), _ordinal_date(base),
        F.lit("</p><p>IPO Close Date : "), _ordinal_date(F.date_add(base, 2)),
        F.lit("</p><p>IPO Allotment Date : "), _ordinal_date(F.date_add(base, 5)),
        F.lit("</p><p>IPO Listing Date : "), F.date_format(F.date_add(base, 7), "d MMM yyyy"),
        F.lit("</p><p>Read the RHP Documents</p></div>"), objects)

    perf = _page(
        F.concat(name, F.lit(" performance")),
        F.lit("<div><p>Face Value: ₹ "), F.when(c % 2 == 0, "10").otherwise("5"),
        F.lit("</p><p>Issue Price: ₹ "), _s(ab), F.lit("</p><p>Listing Price: ₹ "), _s(ab + 5),
        F.lit("</p><p>Listing Gain (%) "), _s(n - 12.5), F.lit(" %</p></div>"))

    sub_table = F.concat(
        F.lit("<div class='panel-box'><table>"), F.lit("<tr><td colspan='3'>Day 3 Bids</td></tr>"),
        _row("Category", "Subscription (times)", "Shares Offered", tag="th"),
        _row("Anchor Investors", "1", "100"),
        _row(F.lit("QIB (Ex Anchor)"), _s(c % 50 + 0.06), F.lit("200")),
        _row(F.lit("Non-Institutional Buyers"), _s(n + 0.73), F.lit("300")),
        _row(F.lit("&nbsp;&nbsp;bNII (bids above ₹10L)"), _s(n + 0.25), F.lit("150")),
        _row(F.lit("- sNII (bids below ₹10L)"), _s(n + 0.68), F.lit("150")),
        _row(F.lit("Retail Investors"), _s(c % 30 + 0.04), F.lit("400")),
        _row("Employees**", "[●]", "10"),
        _row(F.lit("Employees**"), _s(n / 2), F.lit("10")),
        _row("Total", "9.99", "1000"),
        F.lit("<tr><td>Short</td></tr></table></div>"),
        F.lit("<table>"), _row("Category", "Maximum Allottees", "Size (%)", tag="th"),
        _row(F.lit("Anchor Investors"), F.lit("-"), F.concat(_s(30 + n % 10), F.lit("%"))),
        _row("QIB (Ex Anchor)", "-", "20.00%"),
        _row("Retail Investors", "-", "35.50%"),
        _row("Total IPO Subscription", "-", "100%"),
        _row("Total", "-", "100%"),
        F.lit("</table>"))
    pending = F.lit("<div class='panel-box'>Subscription status: [●]</div>")
    sub = _page(F.concat(name, F.lit(" subscription")), F.when(c % 5 == 0, pending).otherwise(sub_table))

    html = dict(zip(SECTIONS, [financials, gmp, info, perf, sub]))
    branches = [customer.select(seg.alias("segment"), F.lit(s).alias("section"), name.alias("company"),
                                html[s].alias("html"))
                for s in (sections or SECTIONS)]
    out = branches[0]
    for b_ in branches[1:]:
        out = out.unionByName(b_)
    return out
