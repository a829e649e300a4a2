"""Crawl work-list operators and small helpers."""
from urllib.parse import parse_qs, urlparse

from pyspark.sql import functions as F

from quarry.operators import frontier as FR
from quarry.operators.extract import extract_gmp, unsupported
from quarry.plans.gold import EDA_FEATURE_GROUPS, feature_group_long


def test_manifest_pages_and_params(spark):
    counts = spark.createDataFrame([("sme", 3)], "segment string, n_pages int")
    rows = FR.page_manifest(counts, "n_pages", "https://h.example/api", cache_buster_ms=1000,
                            keys=["segment"]).orderBy("page").collect()
    assert [r.page for r in rows] == [1, 2, 3]
    q = parse_qs(urlparse(rows[2].url).query, keep_blank_values=True)
    assert q["draw"] == ["3"] and q["start"] == ["20"] and q["_"] == ["1003"] and q["columns[0][data]"] == ["company_link"]


def test_fan_out_skips_null_keyed_section(spark):
    base = spark.createDataFrame([(1, "A B", "a-b", None), (2, "C", "c", "https://g.example/gmp/c/2/")],
                                 "id int, company_name string, slug string, investor_gain string")
    out = FR.fan_out(base, "https://x.example")
    assert out.where("section = 'gmp'").count() == 1
    assert out.where("company = 'a_b' AND section = 'financials'").first().url == \
        "https://x.example/ipo/financial-report/a-b/1"
    routes = {r.section: r.h for r in out.select("section", FR.route("url").alias("h")).where("company = 'c'").collect()}
    assert routes["gmp"] == "gmp" and routes["subscription"] == "subscription" and routes["peers"] == "generic"


def test_classify_response(spark):
    df = spark.createDataFrame([(200, '{"k": 1}'), (200, '{"msg": 0, "error": "x"}'), (429, ""), (503, "oops"),
                                (404, '{"k": 1}'), (200, "not json")], "status int, body string")
    got = [r[0] for r in df.select(FR.classify_response("status", "body", "k")).collect()]
    assert got == ["success", "retry", "retry", "retry", "fail", "fail"]


def test_pending_anti_join(spark):
    frontier = spark.createDataFrame([("a", "gmp"), ("a", "peers"), ("b", "gmp")], "company string, section string")
    fetched = spark.createDataFrame([("a", "gmp"), ("a", "gmp")], "company string, section string")
    assert sorted(tuple(r) for r in FR.pending(frontier, fetched, ["company", "section"]).collect()) == \
        [("a", "peers"), ("b", "gmp")]


def test_feature_groups_and_unsupported_sections(spark):
    long = feature_group_long(EDA_FEATURE_GROUPS, spark)
    assert long.where("group = 'labels'").count() == 2
    pages = spark.createDataFrame([("peers", "<p>x</p>"), ("gmp", "<p>x</p>"), ("review", "")],
                                  "section string, html string")
    assert sorted(tuple(r) for r in unsupported(pages).collect()) == [("peers", 1), ("review", 1)]


def test_page_without_gmp_table_gives_nulls(spark):
    df = spark.createDataFrame([("a", "<p>no table</p>"), ("b", None)], "company string, html string")
    rows = extract_gmp(df).collect()
    assert all(r.ipo_open_gmp is None and r.ipo_listing_gmp is None for r in rows) and len(rows) == 2


def test_distributed_method_in_quantiles_and_describe(spark):
    from quarry.functions.util import read_table
    from quarry.operators.fit import quantiles
    from quarry.operators.profile import describe
    from tests.conftest import SF_SMALL
    li = read_table(spark, SF_SMALL, "lineitem")
    cols = ["l_quantity", "l_extendedprice"]
    a = quantiles(li, cols, [0.05, 0.5, 0.95]).first()
    b = quantiles(li, cols, [0.05, 0.5, 0.95], method="distributed").first()
    assert all(abs(x - y) < 1e-9 for c in cols for x, y in zip(a[c], b[c]))
    assert [tuple(r) for r in describe(li, cols).collect()] == \
        [tuple(r) for r in describe(li, cols, method="distributed").collect()]


def test_rows_to_frame_and_named_layers(spark):
    from quarry.sources import io as IO
    df = IO.rows_to_frame(spark, [{"id": 1, "company_name": "A"}, {"id": 2}], "id int, company_name string")
    IO.register_layers({"combined": df})
    assert spark.sql("SELECT count(*) AS n, count(company_name) AS c FROM combined").first() == (2, 1)
