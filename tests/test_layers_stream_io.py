"""Layers (join chain, dedup, union), streaming re-apply, page-file scan, medallion end to end."""
import os

from pyspark.sql import functions as F

from quarry.functions.util import read_table
from quarry.operators.apply import Artifacts, transform
from quarry.operators.fit import fit
from quarry.operators.layers import dedup_first, join_chain, union_all
from quarry.plans.gold import LINEITEM_STRATEGIES
from quarry.sources import io as IO
from quarry.streaming.apply_stream import apply_to_stream
from tests.conftest import SF_SMALL


def test_join_chain_suffixes_and_null_keys(spark):
    a = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0)], "k int, name string, v double")
    b = spark.createDataFrame([(1, 10.0), (1, 11.0), (None, 99.0)], "k int, v double")
    c = spark.createDataFrame([(2, "B")], "k int, name string")
    out = join_chain([a, b, c], ["k"])
    assert out.columns == ["k", "name_x", "v_x", "v_y", "name_y"]
    rows = {r.k: r for r in out.collect()}
    assert len(rows) == 3 and rows[1].v_y == 10.0 and rows[None].v_y is None and rows[2].name_y == "B"


def test_dedup_first_is_deterministic_under_skew(spark):
    rows = [(0, i, f"x{i}") for i in range(3000)] + [(1, 5, "y")]
    df = spark.createDataFrame(rows, "k int, o int, s string").repartition(8)
    out = sorted(tuple(r) for r in dedup_first(df, ["k"], order=["o"]).collect())
    assert out == [(0, 0, "x0"), (1, 5, "y")]


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, 2.0)], "k int, a double")
    b = spark.createDataFrame([("z", 3)], "b string, k int")
    u = union_all([a, b])
    assert u.columns == ["k", "a", "b"] and u.count() == 2


def test_streaming_reapply_equals_batch(spark, tmp_dir):
    li = read_table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_linenumber", *LINEITEM_STRATEGIES)
    cols = list(LINEITEM_STRATEGIES)
    a = Artifacts.from_frame(fit(li, LINEITEM_STRATEGIES))
    li.repartition(3).write.parquet(tmp_dir + "/in")
    stream = spark.readStream.schema(li.schema).parquet(tmp_dir + "/in")
    q = (apply_to_stream(stream, a, cols, keep=["l_orderkey", "l_linenumber"])
         .writeStream.format("memory").queryName("gold_stream").outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = sorted(tuple(r) for r in spark.table("gold_stream").collect())
    want = sorted(tuple(r) for r in transform(li, a, cols, keep=["l_orderkey", "l_linenumber"]).collect())
    assert got == want


def test_read_html_dir(spark, tmp_dir):
    for seg, sec, name in [("sme", "gmp", "abc_ltd"), ("mainboard", "financials", "x.y")]:
        d = os.path.join(tmp_dir, seg, sec)
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, name + ".html"), "w", encoding="utf-8") as f:
            f.write(f"<p>{name}\n second line</p>")
    rows = sorted(tuple(r) for r in IO.read_html_dir(spark, tmp_dir).collect())
    assert rows == [("mainboard", "financials", "x.y", "<p>x.y\n second line</p>"),
                    ("sme", "gmp", "abc_ltd", "<p>abc_ltd\n second line</p>")]


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    qs, osql = E.queries(), E.oracle_sql()
    assert set(osql) <= set(qs) and len(qs) >= 40
