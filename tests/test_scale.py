"""Work that has to spread, or stay small, however large the tables are."""

import random
import weakref

import pyarrow as pa
from pyspark.sql import functions as F

from quarry.functions import text as TX
from quarry.operators import extract as XT
from quarry.operators import html as H
from quarry.operators.layers import dedup_first
from quarry.plans import catalog


def test_x3_spreads_one_row_group(spark, tmp_dir):
    spark.range(2000).select(F.col("id").alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey"), (F.col("id") * 1.5).alias("c_acctbal")) \
        .coalesce(1).write.parquet(f"{tmp_dir}/customer.parquet")
    out = catalog.QUERIES["x3_labels"](spark, tmp_dir)
    rows = out.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in rows) == 2000
    assert max(r["count"] for r in rows) < 1000


class _Tracked(dict):
    alive, most = set(), 0


def test_page_scan_holds_few_pages_at_once(monkeypatch):
    def tracked(html):
        d = _Tracked({k: [] for k in H.PAGE.names} | {"error": None, "strings": [html]})
        _Tracked.alive.add(id(d))
        weakref.finalize(d, _Tracked.alive.discard, id(d))
        _Tracked.most = max(_Tracked.most, len(_Tracked.alive))
        return d

    monkeypatch.setattr(H, "scan_html", tracked)
    n = 5 * H.PAGES_AT_ONCE + 3
    out = H._scan_udf.func(pa.array([str(i) for i in range(n)]))
    assert [r["strings"] for r in out.to_pylist()] == [[str(i)] for i in range(n)]
    assert _Tracked.most <= H.PAGES_AT_ONCE + 1
    assert len(H._scan_udf.func(pa.array([], pa.string()))) == 0


def test_plain_markup_gives_what_the_parser_gives():
    class Parser(H._Index):
        def _plain(self, html):
            return 0

    page = ("<!DOCTYPE html><html><head><title>A &amp; B</title><script>if (a<b) x = '</p>';</script></head><body><h2>Key <b>x</b></h2>after<p>one</p>"
            "<ul><li>two &nbsp;<li>three</ul><table class=\"t\"><thead><tr><th>h</th></tr></thead><tr><td>1<br/>2</td><td><span class='badge'>Open</span></td></tr></table>")
    assert H._Index()._plain(page) == len(page)                # all of it without the parser
    assert H.scan_html(page) == Parser().run(page).page()
    bits = ["<", ">", "&amp;", "&", '"', "'", "<!--", "-->", "<!-- c -->", "<script>", "</script>", "</script >", "<style>", "</style>", "<title>", "</title>",
            '<td class="a&lt;b">', "</td>", "</td x>", "<br/>", "<img src=x>", "text", "<tr>", "<table>", "</table>", "<p>", "<ul>", "<li>", "</ul>", "<h2>",
            "</h2 >", "<!doctype>", "<?pi>", "<textarea>", "</textarea>", "<a b>", "&#65", "<div class='badge' id=\"k\">", "</div>", "<td a='1'b='2'>", "<İ>"]
    rnd = random.Random(7)
    for _ in range(3000):
        h = "".join(rnd.choice(bits) for _ in range(rnd.randint(1, 14)))
        assert H.scan_html(h) == Parser().run(h).page(), h


def _copies(df, name):
    return df._jdf.queryExecution().optimizedPlan().toString().count(name)


def test_shared_steps_stand_once_in_the_plan(spark):
    """A step that several branches read is worked out once: no copy of its expression for each reader."""
    df = spark.createDataFrame([("x",)], "s string")
    assert _copies(df.select(TX.canonical_category("s")), "lower(") <= 12             # of the text and of each slug
    assert _copies(df.select(XT.label_pieces(TX.html_text("s"))), "(script|style|template)") == 1


def test_incremental_sections_are_read_apart(spark):
    pages = spark.createDataFrame([("sme", s, c, f"<p>{c}</p>") for s in XT.SECTIONS for c in ("a", "b")] + [("sme", "gmp", "c", "<p")],
                                  "segment string, section string, company string, html string")
    keys = ["segment", "section", "company"]
    got = XT.scan_pages(dedup_first(pages, keys), keys, by="section")
    assert (got.n_pages, got.n_failed) == (11, 1)
    assert got.failures.count() == 1 and got.pages.count() == 10
    one = got.pages.where(F.col("section") == "gmp")
    assert {f.split("/")[-2] for f in got.pages.inputFiles()} >= {f"section={s}" for s in XT.SECTIONS}
    assert "PartitionFilters: [isnotnull(section" in one._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["company"] for r in one.collect()) == ["a", "b"]


def test_plain_leaves_cost_no_parser_calls():
    """Elements that hold text only are taken in one step, whatever their number; nothing else is called for them."""
    class Quiet(H._Index):
        def handle_starttag(self, tag, attrs):
            raise AssertionError(tag)
        handle_endtag = handle_data = handle_starttag

    page = "<table><tr>" + "<td class=\"x\">a &amp; b</td>" * 50 + "</tr></table><div><h2>k</h2><p>one</p><ul><li>two</li></ul></div>".replace("<h2>k</h2>", "<h2><i>k</h2>")
    quiet = Quiet()
    assert quiet._plain(page.replace("<i>", "")[:page.index("<div>")]) == page.index("<div>")
    assert len(quiet.cells) == 50 and quiet.strings == ["a & b"] * 50
    assert H.scan_html(page)["lis"] == [{"a": 52, "b": 53}]


def test_character_names_are_looked_up_by_letter(spark):
    """No look-up goes through all 2125 names: a page with references took most of its time there."""
    df = spark.createDataFrame([("&copy;&nbsp;x &rarr; &Rarr; &bogus; &zwnj;y &#8377;",)], "s string")
    assert df.select(TX.html_text("s")).first()[0] == "© x → ↠ &bogus; \u200cy ₹"
    assert "[" not in TX._NAMED_BY_LETTER and max(len(v) for v in TX._NAMED_BY_LETTER.values()) < 300
    assert sum(len(v) for v in TX._NAMED_BY_LETTER.values()) == len(TX._NAMED)


def test_information_text_is_searched_once(spark, tmp_dir):
    """Fields are read from the pieces between colons, equal to a search of the whole text for each field."""
    spark.createDataFrame([("a", "<p>x</p>")], "company string, html string").write.parquet(tmp_dir + "/p")
    plan = XT.extract_information(spark.read.parquet(tmp_dir + "/p"), with_objects=False)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(_text") <= 1
    bits = ["IPO Category", "Exchange", "Issue Type", "Issue Price", "PE multiple", "Subscription", "Pre Issue Promoter Holding", "Post Issue Promoter Holding", "Date of DRHP", "IPO Open Date",
            "IPO Close Date", "IPO Allotment Date", ":", ":", ":", " :", ": ", " ", " ", "12.5", "%", "times", "Market Capitalisation", "Initiation", "IPO Size", "NSE", "\u0085", "Read it"]
    rnd = random.Random(5)
    texts = [" ".join("".join(rnd.choice(bits) for _ in range(rnd.randint(1, 14))).split(" ")) for _ in range(1500)]
    texts = [" ".join(t.split(" ")) for t in texts if "  " not in t and t == t.strip(" ")] + ["Exchange : NSE", "Exchange: BSE Issue Type : Fixed IPO Size x:", "x Exchange:: a"]
    patterns = {**XT.INFORMATION_PATTERNS, **XT.DATE_PATTERNS}
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("p", XT.colon_pieces(F.col("t")))
    for r in df.select("t", *[F.struct(XT.colon_field(F.col("p"), k, v).alias("got"), F.regexp_extract("t", patterns[k], 1).alias("want")).alias(k) for k, _, v in XT._LABELLED]).collect():
        for k, _, _ in XT._LABELLED:
            assert r[k].got == r[k].want, (k, r.t)


def test_labels_are_found_by_one_search(spark):
    """One pattern search gives what a search and a split gave, also where the text holds the marks; labels name their fields."""
    rx = r"(?iu)(?<![\p{L}\p{N}_/&-])(?:" + "|".join(sorted(XT._ALL_LABELS, key=lambda p: (-len(p), p))) + r")(?![\p{L}\p{N}_])"
    bits = ["Total Assets", "Net Assets", "total  revenue", "EBITDA", " margin", "EV / EBITDA", "P/B", "PAT", "a", " ", " ", ":", "-", "/", "NAV", "Net Worth", "Non-current assets",
            "Adj. EPS", "Market Capitalisatio", "a\u017f\u017fets", "ROE", "Debt to Equity", "Net Debt to EBITDA", "Average Net Worth", "\ufdd0", "\ufdd1", "12.5"]
    rnd = random.Random(6)
    texts = ["".join(rnd.choice(bits[:-3] if rnd.random() < 0.9 else bits) for _ in range(rnd.randint(1, 12))) for _ in range(1500)]
    found = F.regexp_extract_all("t", F.lit(rx), F.lit(0))
    rests = F.slice(F.split("t", rx, -1), F.lit(2), F.greatest(F.size(found), F.lit(0)))
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", XT.label_pieces(F.col("t")).alias("got"), F.zip_with(found, rests, lambda a, b: F.struct(a.alias("label"), b.alias("rest"))).alias("want"))
    for r in df.collect():
        assert r.got == r.want, r.t
    fields = df.select(F.explode("got.label").alias("label")).distinct().select("label", XT._field_of(F.col("label")).alias("got"), *[
        F.col("label").rlike(rf"(?iu)^{label}$").alias(k) for k, (label, _) in XT.FINANCIAL_FIELDS.items()])
    for r in fields.collect():
        assert [r.got] == ([k for k in XT.FINANCIAL_FIELDS if r[k]] or [None]), r.label


def test_spaces_as_before(spark):
    """Text without odd spaces takes a shorter way to what ``btrim`` and the patterns give."""
    from quarry.functions import clean as C
    bits = [" ", "  ", "\t", "\n", "\x1c", "\u00a0", "\u2003", "\u3000", "₹", "a", "b", "-", "[●]", "NA", "*", "–", "•", "\u0085", "\x7f"]
    rnd = random.Random(8)
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 7))) for _ in range(2500)] + [None, "", "None", "N/A", " - "]
    trimmed = lambda x: F.btrim(x, F.lit(C._PY_SPACES))
    collapsed = lambda x: trimmed(F.regexp_replace(x, r"(?U)\s+", " "))
    t = F.col("t")
    norm = collapsed(F.regexp_replace(F.regexp_replace(F.regexp_replace(collapsed(t), "\u00a0", " "), r"\*+", ""), r"^\s*[-–•]+", ""))
    r = spark.createDataFrame([(x,) for x in texts], "t string").select(
        "t", C.ustrip("t").alias("a"), trimmed(t).alias("a0"), C.collapse_ws("t").alias("b"), collapsed(t).alias("b0"), C.missing_to_null("t").alias("c"),
        TX.norm_category_text("t").alias("d"), norm.alias("d0"), F.trim(F.regexp_replace("t", TX._SPACES, " ")).alias("e"), F.trim(F.regexp_replace("t", r"[\s\u00a0]+", " ")).alias("e0"))
    for x in r.collect():
        assert (x.a, x.b, x.d, x.e) == (x.a0, x.b0, x.d0, x.e0), repr(x.t)
        assert x.c == (None if x.a0 is None or x.a0 in C.PLACEHOLDER_TOKENS else x.a0)
