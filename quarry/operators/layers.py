"""Table-combining operators: schema union, join chain, clash resolution, dedup.

Dedup is an aggregation (``min`` of a struct per key), not a window: Spark
pre-aggregates map-side, so a key holding a third of all rows is reduced inside
each task before the shuffle instead of landing whole in one sort.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..registry import select_existing
from ..session import cut_lineage


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """Union by name; columns missing on one side become NULL.

    Column order: the first frame's columns, then new ones in order of appearance.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def map_keys_of(df: DataFrame, map_col: str) -> list[str]:
    """S7 discovery: the sorted set of keys present in a map column (one small distinct job)."""
    keys = (df.select(F.explode(F.map_keys(map_col)).alias("k")).distinct()
            .orderBy("k").collect())  # bounded by the number of distinct field names
    return [r["k"] for r in keys]


def map_to_columns(df: DataFrame, map_col: str, keys: list[str] | None = None) -> DataFrame:
    """Dynamic record (map) -> one column per key (sorted); rows without a key get NULL.

    Without ``keys`` the records are written once, then read for the keys and for the columns.
    """
    if keys is None:
        df = cut_lineage(df)
        keys = map_keys_of(df, map_col)
    rest = [c for c in df.columns if c != map_col]
    return df.select(*rest, *[F.col(map_col)[k].alias(k) for k in keys])


def dedup_first(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key, the smallest by ``order`` (then by the remaining columns), NULLs last.

    Deterministic, shuffle-light (partial aggregation: a hot key is one row a task), skew-tolerant.  NULL keys
    form their own group, as in pandas ``drop_duplicates``.  Of rows that differ in a NULL only, the fuller one stays.
    """
    order = [c for c in (order or []) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not rest and not order:
        return df.select(*keys).distinct()
    # each value goes behind its own "is NULL": false sorts before true
    packed = F.struct(*[x for i, c in enumerate(order + rest) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))])
    out = df.groupBy(*keys).agg(F.min(packed).alias("_r"))
    return out.select(*keys, *[F.col(f"_r.v{i}").alias(c) for i, c in enumerate(order + rest)]).select(*df.columns)


def join_chain(tables: list[DataFrame], keys: list[str], how: str = "left",
               suffixes: tuple[str, str] = ("_x", "_y"), dedup: bool = True, reduce_left: bool = False) -> DataFrame:
    """J1 + J2: left-join a list of tables on ``keys`` with pandas-style clash suffixes.

    Null keys never match (they are dropped from the right sides).  With
    ``dedup`` each right side is first reduced to one row per key, so duplicate
    keys cannot multiply rows (a hot key would otherwise explode quadratically).
    ``reduce_left`` does the same to the left side before the joins, where the result is
    reduced to one row per key anyway.
    """
    def right(df: DataFrame) -> DataFrame:
        df = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
        return dedup_first(df, keys) if dedup else df

    out = dedup_first(tables[0], keys) if reduce_left else tables[0]
    for t in tables[1:]:
        t = right(t)
        clash = [c for c in t.columns if c in out.columns and c not in keys]
        if clash:
            out = out.withColumnsRenamed({c: c + suffixes[0] for c in clash})
            t = t.withColumnsRenamed({c: c + suffixes[1] for c in clash})
        out = out.join(t, on=keys, how=how)
    return out


def resolve_clashes(df: DataFrame, drop: list[str] | None = None, rename: dict[str, str] | None = None) -> DataFrame:
    """Q2 + Q3 (silver): drop the losing side of each clash and give the winner its name."""
    df = df.drop(*[c for c in (drop or []) if c in df.columns])
    ren = {k: v for k, v in (rename or {}).items() if k in df.columns}
    return df.withColumnsRenamed(ren) if ren else df


def coalesce_clashes(df: DataFrame, names: list[str], prefer: str = "_y", other: str = "_x") -> DataFrame:
    """J2 alternative resolver: keep the preferred side, fall back to the other when NULL."""
    for n in names:
        a, b = n + prefer, n + other
        if a in df.columns and b in df.columns:
            df = df.withColumn(n, F.coalesce(F.col(a), F.col(b))).drop(a, b)
    return df


def preview(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """Q9: the first ``n`` rows by ``order`` (NULLs last, then by all other columns): the same ones on every run."""
    keys = [*order, *[c for c in df.columns if c not in order]]
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in keys]).limit(n)


def project(df: DataFrame, cols=None, registry_names: list[str] | None = None) -> DataFrame:
    """Q1: the requested columns that exist, in order; ``None`` -> every registry column present."""
    want = cols if cols is not None else (registry_names or [])
    return df.select(*select_existing(df, want))
