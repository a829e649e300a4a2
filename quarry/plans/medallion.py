"""Pages -> raw section tables -> cleaned -> bronze -> silver -> gold.

The reference builds one CSV per (segment, section) and merges per segment.
Here the segment is carried as a join key, so all segments are joined in one
job; every intermediate is a lazy DataFrame (``persist`` or ``write`` a layer
only when several consumers reuse it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import clean_df
from ..operators.extract import EXTRACTORS, SECTIONS
from ..operators.layers import dedup_first, join_chain, map_to_columns, resolve_clashes
from ..session import cut_lineage

# ---- fixed values: silver clash resolution (performance issue price, information PE) -------
SILVER_DROP = ["issue_price_x", "pe_multiple_x"]
SILVER_RENAME = {"issue_price_y": "issue_price", "pe_multiple_y": "pe_multiple"}


def raw_sections(pages: DataFrame, key: str = "company", sections: list[str] | None = None,
                 extra_keys: list[str] | None = None) -> dict[str, DataFrame]:
    """X24 over a page table; ``extra_keys`` (e.g. segment) ride along with the key."""
    extra = list(extra_keys or [])
    out = {}
    for s in sections or SECTIONS:
        p = pages.where(F.col("section") == s)
        if extra:
            p = p.withColumn(key, F.struct(F.col(key).alias(key), *[F.col(k) for k in extra]))
        df = EXTRACTORS[s](p, key=key)
        if extra:
            df = df.select(*[F.col(f"{key}.{k}").alias(k) for k in extra], F.col(f"{key}.{key}").alias(key),
                           *[c for c in df.columns if c != key])
        out[s] = df
    return out


def clean_sections(raw: dict[str, DataFrame], keys: list[str], subscription_keys: list[str] | None = None
                   ) -> dict[str, DataFrame]:
    """P11 per section; the subscription map becomes columns first."""
    out = {}
    for s, df in raw.items():
        if s == "subscription":
            df = map_to_columns(df, "fields", subscription_keys)
        if "object_of_issue" in df.columns:
            df = df.withColumn("object_of_issue", F.array_join("object_of_issue", " | "))
        out[s] = clean_df(df, keep=[k for k in keys if k != "company"])
    return out


def bronze(cleaned: dict[str, DataFrame], key: str = "company", segment: str | None = "segment") -> DataFrame:
    """S14 bronze: per-segment left-join chain in section-name order over one row a key (so the result has one
    row a key, too), union of segments (one job: the segment is a join key), dedup on (key, open_date)."""
    keys = [segment, key] if segment else [key]
    tables = [cleaned[s] for s in sorted(cleaned)]
    per_segment = join_chain(tables, keys, reduce_left=True)
    has_open = "open_date" in per_segment.columns
    return dedup_first(per_segment, [key, "open_date"] if has_open else [key])


def silver(bronze_df: DataFrame) -> DataFrame:
    """S14 silver: resolve the join clashes."""
    return resolve_clashes(bronze_df, SILVER_DROP, SILVER_RENAME)


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a layer once as Parquet: to ``path``, else as a stage in the cluster's checkpoint dir.
    Cuts lineage (executor loss replays one layer only)."""
    if path is None:
        return cut_lineage(df)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def pages_to_silver(pages: DataFrame, subscription_keys: list[str] | None = None,
                    layer_root: str | None = None) -> DataFrame:
    """Pages -> silver.  Each cleaned section table is materialised before the join chain,
    and silver itself once (the gold fit and every feature-group projection read it)."""
    raw = raw_sections(pages, extra_keys=["segment"])
    cleaned = clean_sections(raw, ["segment", "company"], subscription_keys)
    cleaned = {s: materialize(df, f"{layer_root}/cleaned/{s}" if layer_root else None) for s, df in cleaned.items()}
    return materialize(silver(bronze(cleaned)), f"{layer_root}/silver" if layer_root else None)
