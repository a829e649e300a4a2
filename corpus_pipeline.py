"""A training-data pipeline over ``documents``: five stages, each one of the numbered operators.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each result as Parquet
under the shared checkpoint folder and rereads it as the next stage's documents.  All stages but the
last return the columns of ``documents``:

1. toxicity  -- documents scored 0.7 or more go;
2. near copies -- one document of each group of texts linked by five-word shingles (Jaccard 0.8) stays;
3. secrets -- secrets found in a text are masked;
4. mixing -- documents are repeated or left out so that the sources reach their target weights;
5. packing -- the rest becomes pieces of 4096-token sequences.

SQL cannot express the learnt stages, so there is no oracle; ``tests/llm`` holds the stages against
brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import op1_secrets, op2_ngram_join, op4_packing, op5_mixing, op6_toxicity
from quarry.llm.common import read, staged


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op6_toxicity.keep_clean(docs, op6_toxicity.train(docs, read(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op2_ngram_join.drop_near_copies(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op1_secrets.mask_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op5_mixing.sample(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op4_packing.pack_documents(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", toxicity), ("near_copies", near_copies), ("secrets", secrets), ("mixing", mixing),
          ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
