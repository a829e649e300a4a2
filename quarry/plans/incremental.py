"""S7, S11, S14 incrementally: fetched pages are added to a layer on shared storage batch by batch.

A layer has three Parquet tables under one root:

* ``records``   (segment, section, company, fields): one extracted record a page, a map, partitioned by (segment, section)
* ``keys``      (section, field): every field name ever seen, so the schema grows without reading the records
* ``failures``  (segment, section, company, error): the quarantine, partitioned the same way

A batch touches only the partitions of its own pages: their kept records and the new ones are merged (the newest
page of a company wins) and those partitions are replaced; all others stay as they are.  Every merge is written
to the checkpoint folder before the partitions it was read from are replaced, so a job that dies half way is
started again with the same batch and gives the same layer.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import clean_df
from ..operators.extract import SECTIONS, scan_pages
from ..operators.frontier import pending
from ..operators.layers import dedup_first, map_to_columns, union_all
from ..session import cut_lineage
from .medallion import bronze, raw_sections, silver

KEY = ["segment", "section", "company"]
RECORDS = "company string, fields map<string,string>, segment string, section string"
FAILURES = "company string, error string, segment string, section string"
KEYS = "section string, field string"


class Batch(NamedTuple):
    n_pages: int
    n_failed: int
    partitions: list[tuple[str, str]]      # (segment, section) that were replaced


def _table(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """A table of the layer; no rows where it has not been written yet."""
    try:
        t = spark.read.schema(schema).parquet(f"{root}/{name}")
        return t.where("company is not null") if "company" in t.columns else t
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def records(spark: SparkSession, root: str) -> DataFrame:
    return _table(spark, root, "records", RECORDS)


def failures(spark: SparkSession, root: str) -> DataFrame:
    return _table(spark, root, "failures", FAILURES)


def pending_pages(pages: DataFrame, root: str) -> DataFrame:
    """The pages whose record is not in the layer yet; failed ones are tried again."""
    return pending(pages, records(pages.sparkSession, root), KEY)


def _as_map(df: DataFrame) -> DataFrame:
    """A section's record as a map of its fields that have a value."""
    if "fields" in df.columns:
        return df.select("segment", "company", "fields")
    if "object_of_issue" in df.columns:
        df = df.withColumn("object_of_issue", F.array_join("object_of_issue", " | "))
    names = [c for c in df.columns if c not in KEY]
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in names])
    return df.select("segment", "company", F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull())).alias("fields"))


def _replace(new: DataFrame, old: DataFrame, gone: DataFrame, partitions: list[tuple[str, str]], path: str) -> None:
    """Write ``new`` and what is left of ``old`` over ``partitions``.

    ``gone``: keys of the batch, whose old rows go.  A row without a company stands in every partition, as a
    partition without rows would not be replaced; readers leave it out.
    """
    marks = new.sparkSession.createDataFrame(partitions, "segment string, section string").select(
        *[F.col(f.name) if f.name in KEY[:2] else F.lit(None).cast(f.dataType).alias(f.name) for f in new.schema])
    kept = old.join(gone.select(*KEY).distinct(), KEY, "left_anti").unionByName(marks)
    merged = cut_lineage(kept.unionByName(new).repartition("segment", "section", F.pmod(F.xxhash64("company"), F.lit(64))))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("segment", "section").parquet(path)


def _within(df: DataFrame, partitions: list[tuple[str, str]]) -> DataFrame:
    """Rows of the given partitions: a literal filter, so that only their folders are listed and read."""
    hit = [(F.col("segment") == a) & (F.col("section") == b) for a, b in partitions]
    return df.where(reduce(lambda a, b: a | b, hit, F.lit(False)))


def add_pages(pages: DataFrame, root: str) -> Batch:
    """Scan, extract and merge one batch of pages (segment, section, company, html); the newest state of the layer stays readable."""
    spark = pages.sparkSession
    pages = pages.where(F.col("section").isin(SECTIONS)).select(*KEY, "html")
    scanned = scan_pages(dedup_first(pages, KEY), KEY, by="section")
    raw = raw_sections(scanned.pages, extra_keys=["segment"])
    new = cut_lineage(union_all([_as_map(df).withColumn("section", F.lit(s)) for s, df in raw.items()]).select("company", "fields", "segment", "section"))
    both = new.select(*KEY).unionByName(scanned.failures.select(*KEY))
    touched = sorted((r["segment"], r["section"]) for r in both.select("segment", "section").distinct().collect())   # segments x sections
    if not touched:
        return Batch(scanned.n_pages, scanned.n_failed, [])
    _replace(new, _within(records(spark, root), touched), new, touched, f"{root}/records")
    _replace(scanned.failures.select("company", "error", "segment", "section"), _within(failures(spark, root), touched), both, touched, f"{root}/failures")
    seen = new.select("section", F.explode(F.map_keys("fields")).alias("field")).distinct()
    fresh = cut_lineage(seen.join(_table(spark, root, "keys", KEYS), ["section", "field"], "left_anti"))
    if fresh.take(1):
        fresh.coalesce(1).write.mode("append").parquet(f"{root}/keys")
    return Batch(scanned.n_pages, scanned.n_failed, touched)


def read_section(spark: SparkSession, root: str, section: str) -> DataFrame:
    """One section of the layer with a column for every field seen so far."""
    fields = sorted(r["field"] for r in _table(spark, root, "keys", KEYS).where(F.col("section") == section).select("field").distinct().collect())
    return map_to_columns(records(spark, root).where(F.col("section") == section).select("segment", "company", "fields"), "fields", fields)


def silver_of(spark: SparkSession, root: str) -> DataFrame:
    """The silver table of the whole layer."""
    cleaned = {s: cut_lineage(clean_df(read_section(spark, root, s), keep=["segment"])) for s in SECTIONS}
    return cut_lineage(silver(bronze(cleaned)))
