"""Profiling and statistics: profile, describe, row filters, rank correlation, PCA.

All statistics are global aggregates computed in one job each; the driver only
receives O(columns) or O(columns^2) numbers (never rows).
"""

from __future__ import annotations

from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..registry import select_existing
from ..session import cut_lineage
from .fit import as_double, distributed_quantiles


def _as_text(df: DataFrame, c: str) -> Column:
    """A value as text that is equal for equal values; long ones by their SHA-256."""
    kind = df.schema[c].dataType
    x = F.col(c) + F.lit(0.0) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col(c)        # -0.0 is 0.0
    x = F.hex(x) if isinstance(kind, T.BinaryType) else x.cast("string")
    return F.when(F.length(x) > 64, F.concat(F.lit("sha256:"), F.sha2(x, 256))).otherwise(x)


def profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A6 + A8: (column, dtype, non_null, nulls, distinct) for every column, exact.

    One grouped pass over (column, value): repeated values are counted in the tasks, each distinct one is shuffled
    once, and the second aggregate counts them per column.
    """
    cols = select_existing(df, cols or df.columns)
    dtypes = dict(df.dtypes)
    long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _as_text(df, c).alias("v")) for i, c in enumerate(cols)])).alias("x"))
    counts = long.select("x.*").groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    per = counts.groupBy("i").agg(F.sum(F.when(F.col("v").isNotNull(), F.col("n")).otherwise(0)).alias("non_null"),
                                  F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)).alias("nulls"), F.count("v").alias("distinct"))
    every = df.sparkSession.createDataFrame([(i, c, dtypes[c]) for i, c in enumerate(cols)], "i INT, column STRING, dtype STRING")
    return every.join(per, "i", "left").select(
        "column", "dtype", *[F.coalesce(x, F.lit(0)).cast("long").alias(x) for x in ("non_null", "nulls", "distinct")])


SKETCH_LG_K = 14               # 2^14 registers: a standard error of 0.65 % in the number of distinct values


def profile_sketch(df: DataFrame, by: list[str], cols: list[str] | None = None) -> DataFrame:
    """A6, mergeable: (by, column, dtype, rows, non_null, sketch) for each part of a layer, in one aggregate.

    The sketches are small whatever the data; keep them beside the layer and renew those of the parts that change.
    """
    cols = [c for c in select_existing(df, cols or df.columns) if c not in by]
    dtypes = dict(df.dtypes)
    row = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *[x for i, c in enumerate(cols) for x in (
        F.count(c).alias(f"_n{i}"), F.hll_sketch_agg(_as_text(df, c), SKETCH_LG_K).alias(f"_s{i}"))])
    entries = [F.struct(F.lit(c).alias("column"), F.lit(dtypes[c]).alias("dtype"), F.col("_rows").alias("rows"),
                        F.col(f"_n{i}").alias("non_null"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(cols)]
    return row.select(*by, F.inline(F.array(*entries)))


def merge_profiles(sketches: DataFrame) -> DataFrame:
    """(column, dtype, non_null, nulls, distinct) from the sketches of any parts; ``distinct`` is an estimate."""
    return sketches.groupBy("column", "dtype").agg(
        F.sum("non_null").alias("non_null"), F.sum(F.col("rows") - F.col("non_null")).alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"))


def describe(df: DataFrame, cols: list[str] | None = None, method: str = "distributed") -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 % (exact by default), max per numeric column."""
    num = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    cols = [c for c in select_existing(df, cols or df.columns) if isinstance(df.schema[c].dataType, num)]
    probs = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    dist = distributed_quantiles(df, {c: [0.25, 0.5, 0.75] for c in cols}) if method == "distributed" else {}
    aggs = []
    for i, c in enumerate(cols):
        x = as_double(df, c)
        if method == "exact":
            q = F.percentile(x, probs)
        elif method == "distributed":  # exact values computed above, no whole-column buffer
            q = F.first(F.array(*[F.lit(v).cast("double") for v in dist[c][0]]))
        else:
            q = F.percentile_approx(x, probs, F.lit(100_000)).cast("array<double>")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), q.alias(f"q{i}"), F.max(x).alias(f"hi{i}")]
    row = df.agg(*aggs)
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").cast("long").alias("count"),
                        F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"), F.col(f"lo{i}").alias("min"),
                        F.col(f"q{i}")[0].alias("p25"), F.col(f"q{i}")[1].alias("p50"),
                        F.col(f"q{i}")[2].alias("p75"), F.col(f"hi{i}").alias("max"))
               for i, c in enumerate(cols)]
    return row.select(F.inline(F.array(*entries)))


def _bounds(df: DataFrame, col: str, lo_q: float, hi_q: float, method: str = "distributed") -> tuple[float | None, float | None]:
    if method == "distributed":
        v = distributed_quantiles(df, {col: [lo_q, hi_q]})[col][0]
        return (v[0], v[1])
    r = df.agg(F.percentile(as_double(df, col), F.array(F.lit(lo_q), F.lit(hi_q))).alias("q")).first()["q"]
    return (r[0], r[1]) if r else (None, None)


def _between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    if lo is None or hi is None:  # all-NULL column: nothing compares true
        return df.where(F.lit(False))
    # numeric columns compare directly (NaN sorts above every bound, so it drops like NULL),
    # which lets the predicate reach the Parquet scan; text columns are parsed first
    x = as_double(df, col) if isinstance(df.schema[col].dataType, T.StringType) else F.col(col)
    return df.where((x >= F.lit(float(lo))) & (x <= F.lit(float(hi))))


def iqr_filter(df: DataFrame, col: str, factor: float = 1.5, method: str = "distributed") -> DataFrame:
    """Q5: keep rows inside [q1 - f*iqr, q3 + f*iqr] (NULLs drop)."""
    q1, q3 = _bounds(df, col, 0.25, 0.75, method)
    if q1 is None:
        return _between(df, col, None, None)
    iqr = q3 - q1
    return _between(df, col, q1 - factor * iqr, q3 + factor * iqr)


def percentile_filter(df: DataFrame, col: str, low_q: float = 0.01, high_q: float = 0.99,
                      method: str = "distributed") -> DataFrame:
    """Q6: keep rows inside the [low_q, high_q] percentiles (NULLs drop)."""
    lo, hi = _bounds(df, col, low_q, high_q, method)
    return _between(df, col, lo, hi)


def sequential_iqr_filter(df: DataFrame, cols: list[str], factor: float = 1.0, fill_zero: bool = True,
                          checkpoint_every: int = 5, method: str = "distributed") -> DataFrame:
    """Q7: IQR filter per column in turn, each bound refitted on the rows kept so far.

    A true data dependency: one small aggregation job per column.  The plan of
    the result is the source plus k literal filters; lineage is cut by a
    written stage every ``checkpoint_every`` steps for long feature lists.
    """
    cols = select_existing(df, cols)
    out = df.select(*[F.coalesce(as_double(df, c), F.lit(0.0)).alias(c) if fill_zero else as_double(df, c).alias(c)
                      for c in cols], *[c for c in df.columns if c not in cols])
    for i, c in enumerate(cols, 1):
        out = iqr_filter(out, c, factor, method)
        if checkpoint_every and i % checkpoint_every == 0 and i < len(cols):
            out = cut_lineage(out)
    return out


def _vectors(df: DataFrame, cols: list[str]) -> DataFrame:
    clean = df.select(*[as_double(df, c).alias(c) for c in cols]).dropna()
    return VectorAssembler(inputCols=cols, outputCol="_v").transform(clean).select("_v")


def conditional_ranks(base: DataFrame, cols: list[str], holes: list[str]) -> DataFrame:
    """(c, v, r): for every value of every column its average ranks (ties share the mean of their positions).

    ``r[0]`` is the rank among all rows, ``r[1 + h]`` the one among the rows where ``holes[h]`` has a value.  One pass
    counts every (column, value) for all of these sets at once (map-side combined); the counts are range-partitioned,
    summed locally and completed by the totals of the partitions before, so no column is ranked in one task and the
    number of scans does not grow with the pairs.
    """
    sets = ["n0", *[f"n{i + 1}" for i in range(len(holes))]]
    flags = [F.lit(1).cast("long").alias(sets[0]), *[F.col(h).isNotNull().cast("long").alias(n) for h, n in zip(holes, sets[1:])]]
    long = base.select(F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).alias("v"), *flags) for i, c in enumerate(cols)])).alias("x"))
    n = long.select("x.*").where("v is not null").groupBy("c", "v").agg(*[F.sum(s).alias(s) for s in sets])
    # written once: totals and ranks must see the same partitions
    n = cut_lineage(n.repartitionByRange("c", "v").withColumn("_pid", F.spark_partition_id()))
    before = Window.partitionBy("c").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = n.groupBy("c", "_pid").agg(*[F.sum(s).alias(s) for s in sets])
    offsets = totals.select("c", "_pid", *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"{s}_off") for s in sets])
    w = Window.partitionBy("c", "_pid").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = n.select("*", *[F.sum(s).over(w).alias(f"{s}_cum") for s in sets]).join(offsets, ["c", "_pid"])
    return cut_lineage(ranked.select("c", "v", F.array(*[
        F.col(f"{s}_off") + F.col(f"{s}_cum") - (F.col(s) - 1) / 2.0 for s in sets]).alias("r")))


def spearman(df: DataFrame, cols: list[str]) -> DataFrame:
    """M1: Spearman matrix (average ranks for ties) -> long (i, j, col_i, col_j, rho).

    NULLs are left out pair by pair: rho of two columns uses the rows where both have a value, so the rank of a value
    depends on the other column only through which of its rows are present (``conditional_ranks``).  The ranks are
    joined back by value, once a column (AQE broadcasts small rank tables and splits skewed values), and all pairs
    are correlated in one aggregate, which skips a row where either rank is NULL.
    """
    cols = select_existing(df, cols)
    base = df.select(*[as_double(df, c).alias(f"_c{i}") for i, c in enumerate(cols)])
    names = base.columns
    nulls = base.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names]).first()
    holes = [c for c in names if nulls[c]]
    ranks = conditional_ranks(base, names, holes)
    joined = base
    for i, c in enumerate(names):
        joined = joined.join(ranks.where(F.col("c") == i).select(F.col("v").alias(c), F.col("r").alias(f"_r{i}")), c, "left")

    def rank(i: int, j: int):
        """Rank of column i among the rows where column j has a value."""
        return F.col(f"_r{i}")[holes.index(names[j]) + 1 if names[j] in holes else 0]

    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    rho = joined.agg(F.lit(0).alias("_"), *[F.corr(rank(i, j), rank(j, i)).alias(f"c{i}_{j}") for i, j in pairs]).first()
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            v = 1.0 if i == j else rho[f"c{min(i, j)}_{max(i, j)}"]
            rows.append((i, j, a, b, None if v is None else float(v)))
    return df.sparkSession.createDataFrame(rows, "i INT, j INT, col_i STRING, col_j STRING, rho DOUBLE")


def weak_correlation(corr_long: DataFrame, threshold: float = 0.2) -> DataFrame:
    """M2: per column j, whether any |rho(i, j)| above the diagonal (i < j) is below the threshold."""
    return (corr_long.where(F.col("i") < F.col("j"))
            .groupBy(F.col("col_j").alias("column"))
            .agg(F.max((F.abs("rho") < threshold).cast("int")).cast("boolean").alias("weak")))


def standardize(df: DataFrame, cols: list[str], with_mean: bool = True, with_std: bool = True) -> DataFrame:
    """M3: z-scores with the sample standard deviation (one fit job, one projection)."""
    cols = select_existing(df, cols)
    v = VectorAssembler(inputCols=cols, outputCol="_v").transform(df.select(*[as_double(df, c).alias(c) for c in cols]).dropna())
    model = StandardScaler(inputCol="_v", outputCol="_z", withMean=with_mean, withStd=with_std).fit(v)
    z = model.transform(v).select(vector_to_array("_z").alias("_z"))
    return z.select(*[F.col("_z")[i].alias(c) for i, c in enumerate(cols)])


def pca(df: DataFrame, cols: list[str], standardize_first: bool = True) -> tuple[DataFrame, DataFrame]:
    """M4 + M5 + A9: (variance table, loadings table) for all components.

    variance: (pc, explained_ratio, cumulative); loadings: (feature, pc, loading).
    """
    cols = select_existing(df, cols)
    data = standardize(df, cols) if standardize_first else df.select(*[as_double(df, c).alias(c) for c in cols]).dropna()
    v = VectorAssembler(inputCols=cols, outputCol="_v").transform(data)
    model = PCA(k=len(cols), inputCol="_v", outputCol="_p").fit(v)
    ratios = [float(x) for x in model.explainedVariance.toArray()]
    pcs = model.pc.toArray()
    spark = df.sparkSession
    var = spark.createDataFrame([(i + 1, r) for i, r in enumerate(ratios)], "pc INT, explained_ratio DOUBLE")
    var = var.withColumn("cumulative", F.sum("explained_ratio").over(
        Window.orderBy("pc").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    load = spark.createDataFrame([(cols[f], k + 1, float(pcs[f][k])) for f in range(len(cols)) for k in range(len(ratios))],
                                 "feature STRING, pc INT, loading DOUBLE")
    return var, load


def importance(variance: DataFrame, loadings: DataFrame) -> DataFrame:
    """M5 + M6: importance = sum over components of |loading| x explained ratio, descending."""
    return (loadings.join(variance.select("pc", "explained_ratio"), "pc")
            .groupBy("feature").agg(F.sum(F.abs("loading") * F.col("explained_ratio")).alias("importance"))
            .orderBy(F.desc("importance"), "feature"))
