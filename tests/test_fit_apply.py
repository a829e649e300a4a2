"""Properties of fit / apply: bounds, idempotence, artifact round trip, partition independence."""
from pyspark.sql import functions as F

from quarry.functions.util import read_table
from quarry.operators.apply import Artifacts, handle_outliers, impute, transform
from quarry.operators.fit import fit
from quarry.plans.gold import LINEITEM_STRATEGIES, create_gold, create_gold_groups
from quarry.registry import (ColumnStrategy, ImputerPolicy, OutlierPolicy, Registry, group_cols_by_policy,
                             policy_groups_frame)
from quarry.sources import io as IO
from tests.conftest import SF_SMALL

COLS = list(LINEITEM_STRATEGIES)


def _src(spark):
    li = read_table(spark, SF_SMALL, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.when(F.col("l_orderkey") % 7 == 0, None).otherwise(F.col("l_quantity")).alias("l_quantity"),
                     "l_extendedprice", "l_discount",
                     F.when(F.col("l_linenumber") == 2, None).otherwise(F.col("l_tax")).alias("l_tax"))


def _rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_imputed_columns_have_no_nulls(spark):
    src = _src(spark)
    out = impute(src, fit(src, LINEITEM_STRATEGIES), COLS)
    nulls = out.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in COLS]).first()
    assert all(v == 0 for v in nulls)
    assert out.where("l_tax__is_missing = 1").count() == src.where("l_tax IS NULL").count()


def test_clip_is_idempotent_and_inside_bounds(spark):
    src = _src(spark)
    a = Artifacts.from_frame(fit(src, LINEITEM_STRATEGIES))
    once = handle_outliers(src, a, COLS)
    twice = handle_outliers(once, a, COLS)
    assert _rows(once) == _rows(twice)
    lo, hi = a.get("pctl_low")["l_extendedprice"], a.get("pctl_high")["l_extendedprice"]
    r = once.agg(F.min("l_extendedprice"), F.max("l_extendedprice")).first()
    assert lo <= r[0] and r[1] <= hi


def test_artifact_round_trip(spark, tmp_dir):
    src = _src(spark)
    art = fit(src, LINEITEM_STRATEGIES)
    IO.save_artifacts(art, tmp_dir + "/art")
    loaded = IO.load_artifacts(spark, tmp_dir + "/art")
    keep = ["l_orderkey", "l_linenumber"]
    assert _rows(transform(src, Artifacts.from_frame(art), COLS, keep=keep)) == \
        _rows(transform(src, Artifacts.from_frame(loaded), COLS, keep=keep))
    # hard bounds that are None survive as NULL
    assert loaded.where("stat = 'hard_max' AND column = 'l_quantity'").first().value is None


def test_partitioning_does_not_change_results(spark):
    src = _src(spark)
    a = create_gold(src, LINEITEM_STRATEGIES, COLS, keep=["l_orderkey", "l_linenumber"]).features
    b = create_gold(src.repartition(7, "l_linenumber"), LINEITEM_STRATEGIES, COLS,
                    keep=["l_orderkey", "l_linenumber"]).features
    assert _rows(a) == _rows(b)


def test_groups_share_one_fit(spark):
    src = _src(spark)
    groups = {"g1": ["l_quantity", "l_discount"], "g2": ["l_discount", "l_tax", "missing_col"]}
    frames, art = create_gold_groups(src, LINEITEM_STRATEGIES, groups, keep=["l_orderkey", "l_linenumber"])
    assert frames["g2"].columns == ["l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_tax__is_missing"]
    single = create_gold(src, LINEITEM_STRATEGIES, ["l_quantity", "l_discount"], keep=["l_orderkey", "l_linenumber"])
    assert _rows(frames["g1"]) == _rows(single.features)


def test_drop_mode_and_mode_check(spark):
    src = _src(spark)
    a = fit(src, LINEITEM_STRATEGIES)
    dropped = handle_outliers(src, a, COLS, mode="drop")
    assert dropped.count() < src.count()
    try:
        handle_outliers(src, a, COLS, mode="other")
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_registry_lookups(spark):
    reg = Registry()
    assert len(reg.names()) == 53
    assert len(reg.by_imputer(ImputerPolicy.ZERO)) == 12 and len(reg.by_imputer(ImputerPolicy.MEDIAN)) == 29
    assert len(reg.by_outlier(OutlierPolicy.IQR_FILTER)) == 9
    df = spark.createDataFrame([(1.0, 2.0, "x")], "assets double, subscription double, company string")
    assert group_cols_by_policy(df, reg.strategy_map()) == {"median": ["assets"], "zero": ["subscription"],
                                                            "none": ["company"]}
    groups = {r.policy: r.columns for r in policy_groups_frame(reg, spark).collect()}
    assert groups["zero"][0] == "subscription"


def test_approx_method_close_to_exact(spark):
    src = _src(spark)
    s = {"l_extendedprice": ColumnStrategy(ImputerPolicy.MEDIAN)}
    exact = Artifacts.from_frame(fit(src, s)).get("median")["l_extendedprice"]
    approx = Artifacts.from_frame(fit(src, s, method="approx")).get("median")["l_extendedprice"]
    assert abs(exact - approx) / exact < 0.01


def test_distributed_quantiles_exact_with_hot_value(spark):
    from quarry.operators.fit import distributed_quantiles
    src = _src(spark).withColumn("hot", F.when(F.col("l_orderkey") % 3 == 0, F.lit(7.0))
                                 .otherwise(F.col("l_extendedprice")))
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    cols = {"hot": probs, "l_quantity": probs, "l_tax": probs}
    got = distributed_quantiles(src, cols)
    want = src.agg(*[F.percentile(c, F.array(*[F.lit(p) for p in probs])).alias(c) for c in cols]).first()
    for c in cols:
        assert [round(v, 9) for v in got[c][0]] == [round(v, 9) for v in want[c]]


def test_distributed_quantiles_of_tiny_ranges_heavy_tails_and_no_values(spark):
    from quarry.operators.fit import distributed_quantiles
    src = spark.range(25_000).select(
        F.when(F.col("id") < 3, F.col("id") * 5e-324).alias("tiny"),
        F.pow(F.lit(1.02), F.col("id") % 30_000).alias("tail"), F.lit(None).cast("double").alias("none"))
    got = distributed_quantiles(src, {"tiny": [0.0, 0.5, 1.0], "tail": [0.0, 0.5], "none": [0.5]})
    assert got["tiny"][0] == [0.0, 5e-324, 1e-323]
    assert got["tail"][0][0] == 1.0 and got["tail"][1] == 1.0
    assert got["none"] == ([None], None, None)
