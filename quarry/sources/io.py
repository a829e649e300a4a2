"""Sources and sinks: page files, CSV, JSON payloads, artifacts, named layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.fit import ARTIFACT_SCHEMA


def path_key(path) -> F.Column:
    """File stem from a path (percent-decoded, extension stripped).

    Only the last extension is removed, so 'a.b.html' -> 'a.b' (distinct keys stay distinct).
    """
    p = F.col(path) if isinstance(path, str) else path
    name = F.element_at(F.split(F.coalesce(F.try_url_decode(p), p), "/"), -1)
    return F.regexp_replace(name, r"\.[^.]*$", "")


def path_part(path, depth_from_end: int) -> F.Column:
    """S3: a directory level of the path (1 = parent directory of the file)."""
    p = F.col(path) if isinstance(path, str) else path
    return F.element_at(F.split(p, "/"), -1 - depth_from_end)


def read_html_dir(spark: SparkSession, root: str, pattern: str = "*/*/*.html") -> DataFrame:
    """``root/<segment>/<section>/<company>.html`` -> (segment, section, company, html).

    One row per file (``wholetext``); files are split across tasks by Spark.
    """
    df = spark.read.text(f"{root.rstrip('/')}/{pattern}", wholetext=True)
    fp = F.col("_metadata.file_path")
    return df.select(path_part(fp, 2).alias("segment"), path_part(fp, 1).alias("section"),
                     path_key(fp).alias("company"), F.col("value").alias("html"))


def write_pages(pages: DataFrame, root: str) -> None:
    """Persist a page table partitioned by segment/section (partition pruning on read)."""
    pages.write.mode("overwrite").partitionBy("segment", "section").parquet(root)


def read_csv_text(spark: SparkSession, path: str, null_values: str | None = None, quoted_newlines: bool = False) -> DataFrame:
    """CSV with a header, every column read as text (no inference).

    ``quoted_newlines`` reads values that hold line ends, but a whole file in one task; ``read_csv_typed`` splits such
    files.
    """
    r = (spark.read.option("header", True).option("inferSchema", False).option("multiLine", quoted_newlines).option("escape", '"'))
    if null_values is not None:
        r = r.option("nullValue", null_values)
    return r.csv(path)


def csv_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """The records of CSV files as text, read in splits: a quoted value may hold line ends, also across splits.

    A line end ends a record when the number of quotes before it in its file is even.  Each split counts its quotes;
    the parities of the splits before it (one small row a split) say whether it starts inside a quoted value.  Only
    lines of records of several lines are grouped.  A file with an unbalanced quote is read as the format says: the
    rest of it is one record.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"))
    lines = lines.withColumn("q", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    order = Window.partitionBy("file").orderBy("split")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "split").agg(F.sum("q").alias("q"), F.min("id").alias("head"))
    splits = splits.select("file", "split", "head", (F.coalesce(F.sum("q").over(earlier), F.lit(0)) % 2).alias("open"))
    here = Window.partitionBy("file", "split").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.join(splits, ["file", "split"]).withColumn("upto", F.col("open") + F.sum("q").over(here))
    lines = lines.select("file", "split", "id", "value", "head", ((F.col("upto") - F.col("q")) % 2 == 0).alias("starts"), (F.col("upto") % 2 == 0).alias("ends"))
    # the last record start of every split, carried to the splits behind it
    lines = lines.withColumn("rec", F.last(F.when(F.col("starts"), F.struct("split", "id")), True).over(here))
    carry = lines.groupBy("file", "split").agg(F.max("rec").alias("rec"))
    carry = carry.select("file", "split", F.last("rec", True).over(earlier).alias("carried"))
    first = (F.col("split") == 0) & (F.col("id") == F.col("head")) if header else F.lit(False)
    single = lines.where(F.col("starts") & F.col("ends") & ~first).select("value")
    several = lines.where(~(F.col("starts") & F.col("ends"))).join(carry, ["file", "split"]).withColumn("rec", F.coalesce("rec", "carried"))
    joined = several.groupBy("file", "rec").agg(F.array_sort(F.collect_list(F.struct("split", "id", "value"))).alias("parts"),
                                                F.max(first).alias("header"))
    joined = joined.where(~F.col("header")).select(F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"))
    return single.unionByName(joined).where(F.trim("value") != "")


REJECT = "_corrupt_record"


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """CSV read with a declared schema (never inferred); ``_corrupt_record`` holds a record that does not fit it.

    Columns are taken by position.  A rejected record keeps the values that could be read.
    """
    declared = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    full = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in declared) + f", {REJECT} string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECT, "escape": '"'}
    return csv_records(spark, path, header).select(F.from_csv("value", full, options).alias("r")).select("r.*")


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV export with a header in parallel part files; ``single_file`` writes one file in one task and is
    meant for exports of a few rows."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """The default sink, Parquet."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def parse_payload(payload: DataFrame, col: str, row_schema: T.StructType | str, fields: list[str] | None = None,
                  data_key: str = "data") -> DataFrame:
    """Paged JSON payload -> rows, projected to the requested fields that exist."""
    rs = T._parse_datatype_string(row_schema) if isinstance(row_schema, str) else row_schema
    schema = T.StructType([T.StructField(data_key, T.ArrayType(rs))])
    rows = payload.select(F.explode(F.from_json(F.col(col), schema)[data_key]).alias("r")).select("r.*")
    keep = [f for f in (fields or rows.columns) if f in rows.columns]
    return rows.select(*keep)


def rows_to_frame(spark: SparkSession, rows: list[dict], schema: T.StructType | str) -> DataFrame:
    """Driver-side records -> DataFrame with an explicit schema (small, configuration-sized input)."""
    return spark.createDataFrame(rows, schema)


def save_artifacts(art: DataFrame, path: str) -> None:
    """Artifact frame -> JSON lines (NULL hard bounds are omitted and read back as NULL)."""
    art.coalesce(1).write.mode("overwrite").json(path)


def load_artifacts(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines -> artifact frame with the fixed schema."""
    return spark.read.schema(ARTIFACT_SCHEMA).json(path)


def register_layers(layers: dict[str, DataFrame]) -> None:
    """Named readers for layers (``combined``, per-segment, silver, ...) as temp views."""
    for name, df in layers.items():
        df.createOrReplaceTempView(name)
