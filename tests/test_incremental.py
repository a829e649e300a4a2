"""Incremental layers, typed CSV in splits, rank correlation by null pattern, mergeable profiles."""
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.functions.util import read_table
from quarry.operators import profile as PR
from quarry.operators.layers import dedup_first, join_chain
from quarry.plans import incremental as INC
from quarry.plans.fixtures import render_pages
from quarry.sources import io as IO
from tests.conftest import SF_SMALL

SUB = "<table><tr><th>Category</th><th>Subscription (times)</th></tr><tr><td>{}</td><td>{}</td></tr></table>"


def page(name, category, value):
    return ("sme", "subscription", name, SUB.format(category, value))


def test_layer_grows_batch_by_batch(spark, tmp_dir):
    root, schema = tmp_dir + "/layer", "segment string, section string, company string, html string"
    first = spark.createDataFrame([page("a", "QIB", "1"), page("b", "QIB", "2"), ("sme", "subscription", "c", None),
                                   ("mainboard", "subscription", "d", SUB.format("QIB", "9")), ("sme", "other", "x", "<p>")], schema)
    b = INC.add_pages(first, root)
    assert (b.n_pages, b.n_failed, b.partitions) == (4, 1, [("mainboard", "subscription"), ("sme", "subscription")])
    assert [tuple(r) for r in INC.failures(spark, root).collect()] == [("c", "no content", "sme", "subscription")]
    # pending: only what has no record; then a page with a new field and a newer page of a known company
    again = spark.createDataFrame([page("a", "QIB", "1"), page("c", "Retail Investors", "5")], schema)
    todo = INC.pending_pages(again, root)
    assert [r.company for r in todo.collect()] == ["c"]
    assert INC.add_pages(todo, root).partitions == [("sme", "subscription")]
    INC.add_pages(spark.createDataFrame([page("b", "Employees", "7")], schema), root)
    got = {r.company: r.asDict() for r in INC.read_section(spark, root, "subscription").collect()}
    assert {c: {k: v for k, v in r.items() if v and k.startswith("sub")} for c, r in got.items()} == {
        "a": {"subscription_qib": "1"}, "b": {"subscription_employees": "7"}, "c": {"subscription_retail_investors": "5"}, "d": {"subscription_qib": "9"}}
    assert INC.failures(spark, root).count() == 0
    assert INC.add_pages(first.limit(0), root).partitions == []


def test_two_batches_equal_one(spark, tmp_dir):
    pages = render_pages(read_table(spark, SF_SMALL, "customer").limit(12))
    INC.add_pages(pages, tmp_dir + "/one")
    INC.add_pages(pages.where("company < 'customer_000000006'"), tmp_dir + "/two")
    INC.add_pages(INC.pending_pages(pages, tmp_dir + "/two"), tmp_dir + "/two")
    one, two = (INC.silver_of(spark, tmp_dir + d) for d in ("/one", "/two"))
    assert one.columns == two.columns and one.count() == 12
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


@pytest.mark.parametrize("split", ["64", "400", "128m"])
def test_typed_csv_in_splits(spark, tmp_dir, split):
    r, rows = random.Random(1), []
    for i in range(120):
        note = r.choice(["plain", 'quoted "x"', "two\nlines", "\n\n", 'a,"b"\n"c",\n', "", "é" * 40])
        rows.append((i, r.choice(["1.5", "-2", "bad", ""]), note))
    text = "id,price,note\n" + "".join('{},{},"{}"\n'.format(i, p, n.replace('"', '""')) for i, p, n in rows)
    for k in range(2):
        with open(f"{tmp_dir}/part{k}.csv", "w", encoding="utf-8", newline="") as f:
            f.write(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = IO.read_csv_typed(spark, tmp_dir, "id long, price double, note string").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = sorted((i, None if p in ("bad", "") else float(p), n or None, p == "bad") for i, p, n in rows * 2)
    assert sorted((x.id, x.price, x.note or None, x._corrupt_record is not None) for x in got) == sorted(want)


def test_spearman_pairwise_nulls(spark):
    r = random.Random(3)
    rows = [tuple(None if r.random() < p else float(r.randrange(9)) for p in (0, 0.2, 0.5, 0.9, 1)) for _ in range(300)]
    cols = list("abcde")
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(4)
    want = pd.DataFrame(rows, columns=cols).astype(float).corr("spearman")
    for x in PR.spearman(df, cols).collect():
        w = want.loc[x.col_i, x.col_j]
        if x.i != x.j:
            assert (x.rho is None or x.rho != x.rho) if pd.isna(w) else abs(x.rho - w) < 1e-9, (x, w)


def test_profiles(spark):
    rows = [(i % 7, f"v{i % 50}" * 40, -0.0 if i % 2 else 0.0, None if i % 3 else i, "p" + str(i % 4)) for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b string, c double, d int, part string").repartition(3)
    exact = {r.column: (r.non_null, r.nulls, r.distinct) for r in PR.profile(df).collect()}
    assert exact == {"a": (1000, 0, 7), "b": (1000, 0, 50), "c": (1000, 0, 1), "d": (334, 666, 334), "part": (1000, 0, 4)}
    parts = PR.profile_sketch(df, ["part"])
    got = {r.column: (r.non_null, r.nulls, r.distinct) for r in PR.merge_profiles(parts).collect()}
    assert all(got[c][:2] == exact[c][:2] and abs(got[c][2] - exact[c][2]) <= 0.03 * exact[c][2] for c in "abcd")
    assert {r.column: r.distinct for r in PR.profile(df.limit(0)).collect()} == dict.fromkeys(exact, 0)


def test_dedup_keeps_the_fuller_row(spark):
    df = spark.createDataFrame([(1, None, "b"), (1, "a", "c"), (2, None, None), (2, None, "z")], "k int, x string, y string")
    assert sorted(tuple(r) for r in dedup_first(df, ["k"]).collect()) == [(1, "a", "c"), (2, None, "z")]
    right = spark.createDataFrame([(1, 5)], "k int, v int")
    assert join_chain([df, right], ["k"], reduce_left=True).select("k", "x", "v").sort("k").collect()[0] == (1, "a", 5)
    assert df.where(F.lit(False)).transform(lambda d: dedup_first(d, ["k"])).count() == 0
