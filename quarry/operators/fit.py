"""Fitting of imputation / outlier / normalisation statistics.

All statistics of all columns come out of one pass over the rows: quantiles that any policy
needs, plus ``min``/``max``.  The result is a long artifact DataFrame ``(column, stat, value)``.

Quantile methods (all chosen explicitly, never switched silently):

* ``"distributed"``, the default: exact values (linear interpolation, equal to pandas
  ``quantile`` and DuckDB ``quantile_cont``) by rank over range-partitioned value counts
  (``distributed_quantiles``); no task holds a whole column.
* ``"exact"``: the same values by ``percentile``, lazy and in one aggregation.  Its buffer is a
  value->count map merged in one final task, so it only suits columns of few distinct values.
* ``"approx"``: ``percentile_approx`` with an explicit ``accuracy``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import finite_or_null, strict_double, ustrip
from ..registry import (ColumnStrategy, ImputerPolicy, NormalizationPolicy, OutlierPolicy,
                        select_existing)
from ..session import cut_lineage

ARTIFACT_SCHEMA = T.StructType([
    T.StructField("column", T.StringType(), False),
    T.StructField("stat", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
])

_MEDIAN_IMPUTE = {ImputerPolicy.MEDIAN, ImputerPolicy.MEDIAN_WITH_MISSING_INDICATOR}
_ZERO_IMPUTE = {ImputerPolicy.ZERO, ImputerPolicy.ZERO_WITH_MISSING_INDICATOR}
_INDICATOR = {ImputerPolicy.MEDIAN_WITH_MISSING_INDICATOR, ImputerPolicy.ZERO_WITH_MISSING_INDICATOR}
_PCTL = {OutlierPolicy.PCTL_CLIP, OutlierPolicy.PCTL_FILTER, OutlierPolicy.CLIP_THEN_PCTL_CLIP}


def as_double(df: DataFrame, c: str) -> Column:
    """Coerce to DOUBLE; unparsable text, NaN and infinities become NULL."""
    dtype = df.schema[c].dataType
    x = F.col(c)
    if isinstance(dtype, T.StringType):
        return strict_double(ustrip(x))
    if not isinstance(dtype, T.DoubleType):
        x = x.cast("double")
    return finite_or_null(x)


def ensure_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """P12 as a DataFrame transform (returns a new frame; the input is untouched)."""
    cols = select_existing(df, cols)
    return df.withColumns({c: as_double(df, c) for c in cols}) if cols else df


def _needs(s: ColumnStrategy) -> tuple[list[float], bool, bool]:
    qs: set[float] = set()
    need_min = need_max = False
    if s.imputer in _MEDIAN_IMPUTE:
        qs.add(0.5)
    if s.outlier in _PCTL:
        qs.update((s.pctl_low, s.pctl_high))
    elif s.outlier == OutlierPolicy.IQR_FILTER:
        qs.update((0.25, 0.75))
    if s.normalization == NormalizationPolicy.ROBUST_Z:
        qs.update((0.25, 0.5, 0.75))
    elif s.normalization == NormalizationPolicy.LOG1P:
        need_min = True
    elif s.normalization == NormalizationPolicy.MINMAX:
        need_min = need_max = True
    return sorted(qs), need_min, need_max


def fit(df: DataFrame, strategies: dict[str, ColumnStrategy], cols=None, *,
        method: str = "distributed", accuracy: int = 100_000) -> DataFrame:
    """I1 + O1 + Z1/Z3/Z5 in one pass over the rows; returns the artifact frame.

    ``cols`` restricts the fit to requested columns that exist (Q1 semantics);
    columns without a strategy are skipped.
    """
    if method not in {"exact", "approx", "distributed"}:
        raise ValueError("method must be 'exact', 'approx' or 'distributed'")
    target = [c for c in select_existing(df, cols if cols is not None else list(strategies))
              if c in strategies and strategies[c].is_numeric]
    aggs: list[Column] = []
    plan: list[tuple[str, ColumnStrategy, list[float], bool, bool]] = []
    for i, c in enumerate(target):
        s = strategies[c]
        qs, need_min, need_max = _needs(s)
        x = as_double(df, c)
        if qs:
            qarr = F.array(*[F.lit(q) for q in qs])
            p = (F.percentile(x, qarr) if method == "exact"
                 else F.percentile_approx(x, qarr, F.lit(accuracy)).cast("array<double>"))
            aggs.append(p.alias(f"q{i}"))
        if need_min:
            aggs.append(F.min(x).alias(f"mn{i}"))
        if need_max:
            aggs.append(F.max(x).alias(f"mx{i}"))
        plan.append((c, s, qs, need_min, need_max))

    spark = df.sparkSession
    if not plan:
        return spark.createDataFrame([], ARTIFACT_SCHEMA)
    if method == "distributed":
        # exact, without a whole-column buffer in one task: statistics arrive as literals
        res = distributed_quantiles(df, {c: qs for c, _, qs, lo, hi in plan if qs or lo or hi})
        lits = []
        for i, (c, _s, qs, need_min, need_max) in enumerate(plan):
            vals, mn, mx = res.get(c, ([], None, None))
            if qs:
                lits.append(F.array(*[F.lit(v).cast("double") for v in vals]).alias(f"q{i}"))
            if need_min:
                lits.append(F.lit(mn).cast("double").alias(f"mn{i}"))
            if need_max:
                lits.append(F.lit(mx).cast("double").alias(f"mx{i}"))
        stats = spark.range(1).select(*(lits or [F.lit(1).alias("_")]))
    elif not aggs:  # only zero-fill / hard bounds: no data pass needed, but keep it a frame
        stats = spark.range(1).select(F.lit(1).alias("_"))
    else:
        stats = df.agg(*aggs)

    rows: list[Column] = []

    def add(c: str, stat: str, value: Column | float | None):
        v = value if isinstance(value, Column) else F.lit(value)
        rows.append(F.struct(F.lit(c).alias("column"), F.lit(stat).alias("stat"),
                             v.cast("double").alias("value")))

    def finite(v: Column) -> Column:
        return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))

    for i, (c, s, qs, need_min, need_max) in enumerate(plan):
        def q(p: float, _i=i, _qs=qs) -> Column:
            return F.col(f"q{_i}")[_qs.index(p)]

        if s.imputer in _MEDIAN_IMPUTE:
            add(c, "median", q(0.5))
        if s.imputer in _ZERO_IMPUTE:
            add(c, "zero_fill", 0.0)
        if s.imputer in _INDICATOR:
            add(c, "missing_indicator", 1.0)
        if s.outlier != OutlierPolicy.NONE:
            add(c, "hard_min", s.hard_min)
            add(c, "hard_max", s.hard_max)
        if s.outlier in _PCTL:
            add(c, "pctl_low", q(s.pctl_low))
            add(c, "pctl_high", q(s.pctl_high))
        elif s.outlier == OutlierPolicy.IQR_FILTER:
            q1, q3 = q(0.25), q(0.75)
            add(c, "iqr_low", q1 - F.lit(s.iqr_k) * (q3 - q1))
            add(c, "iqr_high", q3 + F.lit(s.iqr_k) * (q3 - q1))
        if s.normalization == NormalizationPolicy.LOG1P:
            mn = F.col(f"mn{i}")
            add(c, "log1p_shift", F.when(finite(mn) & (mn <= -1.0), -mn + 1.0).otherwise(0.0))
        elif s.normalization == NormalizationPolicy.ROBUST_Z:
            iqr = q(0.75) - q(0.25)
            add(c, "robust_median", q(0.5))
            add(c, "robust_iqr", F.when(finite(iqr) & (iqr != 0.0), iqr).otherwise(1.0))
        elif s.normalization == NormalizationPolicy.MINMAX:
            add(c, "minmax_min", F.col(f"mn{i}"))
            add(c, "minmax_max", F.col(f"mx{i}"))

    return stats.select(F.inline(F.array(*rows)))


def quantiles(df: DataFrame, cols: list[str], probs: list[float], *, method: str = "distributed",
              accuracy: int = 100_000) -> DataFrame:
    """A1/A2/A3: one row, one ``array<double>`` per column, all in one job
    (``method="distributed"``: exact values without a whole-column buffer)."""
    cols = select_existing(df, cols)
    qarr = F.array(*[F.lit(float(p)) for p in probs])
    if method == "exact":
        return df.agg(*[F.percentile(as_double(df, c), qarr).alias(c) for c in cols])
    if method == "distributed":
        res = distributed_quantiles(df, {c: list(probs) for c in cols})
        return df.sparkSession.range(1).select(
            *[F.array(*[F.lit(v).cast("double") for v in res[c][0]]).alias(c) for c in cols])
    return df.agg(*[F.percentile_approx(as_double(df, c), qarr, F.lit(accuracy)).cast("array<double>").alias(c)
                    for c in cols])


def distributed_quantiles(df: DataFrame, cols: dict[str, list[float]]) -> dict[str, tuple[list[float | None], float | None,
                                                                                        float | None]]:
    """Exact linear-interpolated quantiles without a whole column in one task.

    The distinct values of all columns with their counts (map-side combined, so a hot value is one
    row) are range-partitioned by (column, value) and written once.  Each partition sums its counts; the totals (one row a
    column and partition) tell which partition holds a wanted rank, only those are read again, and of them
    only the rows with a wanted rank, two per probability, reach the driver.  Infinite values rank like any other.  Returns
    {col: (values, min, max)}, Nones for a column without values.
    """
    names = list(cols)
    if not names:
        return {}
    entries = F.array(*[F.struct(F.lit(i).alias("i"), as_double(df, c).alias("x")) for i, c in enumerate(names)])
    counts = (df.select(F.inline(entries)).where("x is not null and not isnan(x)")
              .groupBy("i", "x").agg(F.count(F.lit(1)).alias("n")))
    counts = counts.repartitionByRange("i", "x").withColumn("pid", F.spark_partition_id()).sortWithinPartitions("i", "x")
    counts = cut_lineage(counts)
    part = (counts.groupBy("i", "pid").agg(F.sum("n").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
            .orderBy("i", "pid").collect())                       # a row for each column and partition that holds it
    of = {i: [r for r in part if r["i"] == i] for i in {r["i"] for r in part}}
    whole = {i: {"lo": min(r["lo"] for r in rs), "hi": max(r["hi"] for r in rs), "n": sum(r["n"] for r in rs)} for i, rs in of.items()}
    spots: dict[str, list[tuple[int, int, float]]] = {}
    for i, c in enumerate(names):
        last = whole[i]["n"] - 1 if i in whole else -1
        spots[c] = [(int(p * last), min(int(p * last) + 1, last), p * last - int(p * last)) for p in cols[c]] \
            if last >= 0 else []
    wanted = []                                                   # (column, partition, rank in it, rank)
    for i, k in sorted({(i, k) for i, c in enumerate(names) for spot in spots[c] for k in spot[:2]}):
        rest = k
        for r in of[i]:
            if rest < r["n"]:
                wanted.append((i, r["pid"], rest, k))
                break
            rest -= r["n"]
    at = {}
    if wanted:
        ranks = df.sparkSession.createDataFrame(wanted, "i int, pid int, r long, k long")
        upto = Window.partitionBy("i", "pid").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        # only the files of these partitions are read
        held = counts.where(F.col("pid").isin(sorted({w[1] for w in wanted}))).join(F.broadcast(ranks.select("i", "pid").distinct()), ["i", "pid"])
        found = held.withColumn("run", F.sum("n").over(upto)).join(F.broadcast(ranks), ["i", "pid"]).where("r >= run - n and r < run")
        at = {(r["i"], r["k"]): r["x"] for r in found.select("i", "k", "x").collect()}
    out = {}
    for i, c in enumerate(names):
        vals: list[float | None] = [None] * len(cols[c])
        for j, (k0, k1, frac) in enumerate(spots[c]):
            a, b = at[(i, k0)], at[(i, k1)]
            vals[j] = a if frac == 0 or a == b else (1 - frac) * a + frac * b
        out[c] = (vals, whole[i]["lo"] if i in whole else None, whole[i]["hi"] if i in whole else None)
    return out
