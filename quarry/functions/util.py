"""Small DataFrame helpers shared by the query catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE/FLOAT column (stable hashes across engines)."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
