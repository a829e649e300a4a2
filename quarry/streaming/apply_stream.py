"""G7 on a stream: apply fitted artifacts to a streaming DataFrame.

Fits are batch jobs; the apply side is stateless (one projection with inlined
literals, plus a filter in drop mode), so it runs unchanged inside Structured
Streaming micro-batches.  No state store, no watermark needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.apply import Artifacts, transform


def apply_to_stream(stream: DataFrame, artifacts, cols: list[str], *, mode: str = "clip",
                    keep: list[str] | None = None) -> DataFrame:
    """Streaming DataFrame in, streaming DataFrame out (same expressions as the batch path)."""
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame")
    a = artifacts if isinstance(artifacts, Artifacts) else Artifacts.from_frame(artifacts)
    return transform(stream, a, cols, mode=mode, keep=keep)


def start_parquet_sink(features: DataFrame, path: str, checkpoint: str, trigger_once: bool = False) -> StreamingQuery:
    """Append features to a Parquet sink with an exactly-once checkpoint."""
    w = features.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    w = w.outputMode("append")
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()


def parquet_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """A file stream over a Parquet directory (schema declared, never inferred); no file limit unless given."""
    r = spark.readStream.schema(schema)
    return (r.option("maxFilesPerTrigger", max_files) if max_files else r).parquet(path)
