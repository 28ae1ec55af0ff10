"""Toxicity of the whole ``documents`` table. No SQL: a trained model; ``tests/llm/test_toxicity.py`` checks held-out accuracy and the model's arithmetic."""

from addrweave.llm.store import documents
from addrweave.llm.toxicity import toxicity

QUERIES = {"op2_toxicity": lambda spark, sf_dir: toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))}
ORACLES: dict[str, str] = {}
