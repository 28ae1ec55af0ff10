"""Whitened components of the whole ``embeddings`` table."""

from pyspark.sql import functions as F

from addrweave.llm.whitening import whitened

#: Components come from an iteration and have no fixed sign, so there is no SQL; ``tests/llm/test_whitening.py`` compares with dense linear algebra.
QUERIES = {"op13_embedding_whitening": lambda spark, sf_dir: whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))}
ORACLES: dict[str, str] = {}
