"""Cutting lineage: a Parquet table in the shared checkpoint folder, and reading of the input tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from addrweave.session import checkpoint_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder of ``spark.checkpoint.dir``: computed once, safe when executors go."""
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that further columns of any name do no harm."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
