"""Spark session helpers.

Cluster jobs get their session (and their ``spark.checkpoint.dir``) from the
platform; ``get_spark`` only fills in defaults that are unset, which is what
tests and ``bench.py`` rely on when they run on ``local[N]``.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # whole HTML pages are large rows: keep Arrow batches to the Python parser small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # no Python call-site capture per Column call: plan building for wide extraction
    # expressions is dominated by py4j round trips otherwise (static, so set at build time)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "quarry", shuffle_partitions: int = 8,
              driver_memory: str = "8g") -> SparkSession:
    """Return the active session, or build one; settings the submission already made are kept.

    Only what is unset is filled in: a job submitted to a cluster keeps its master, its shuffle
    partitions and everything else.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    from pyspark import SparkConf
    given = SparkConf()
    wanted = {**_LOCAL_DEFAULTS, "spark.sql.shuffle.partitions": str(shuffle_partitions),
              "spark.driver.memory": driver_memory, "spark.master": master or "local[8]", "spark.app.name": app}
    b = SparkSession.builder
    for k, v in wanted.items():
        if not given.contains(k):
            b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a scratch folder only on a local master.

    On any other master a missing setting is an error: executors would write to their own disks.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="quarry-ckpt-", dir=os.environ.get("QUARRY_SCRATCH", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - some sessions reject core configs at runtime
            pass
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, by: str | None = None) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint dir and reread (survives executor loss).

    An eager ``checkpoint()`` runs the plan twice, once to count and once to write; this runs it once, and readers
    get column pruning and row-group statistics.  The folders are named ``quarry-stage-*`` and may be deleted when the
    job has ended.  ``by``: a column of few values other than NULL and '', whose rows are read apart later.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-stage-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
