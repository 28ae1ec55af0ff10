"""From raw documents to packed sequences: five stages, each over all rows that the one before kept.

Toxic documents go, one document of each near-duplicate group stays, documents with benchmark items go, secrets are masked in the text,
and what is left is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from addrweave.llm.decontamination import clean
from addrweave.llm.near_duplicates import without_near_duplicates
from addrweave.llm.packing import packed
from addrweave.llm.secrets import without_secrets
from addrweave.llm.store import documents, written
from addrweave.llm.tokens import vocabulary
from addrweave.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(docs, vocabulary())


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secret_scan", secret_scan), ("packing", packing)]

#: Trained models, similarities and tokenizers have no SQL; ``tests/llm/test_pipeline.py`` compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
