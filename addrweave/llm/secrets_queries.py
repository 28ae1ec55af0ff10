"""Secrets of the whole ``documents`` table. No SQL: SQL has no primed compressor; ``tests/llm/test_secrets.py`` checks the fixed patterns and the novelty apart."""

from addrweave.llm.secrets import secrets
from addrweave.llm.store import documents

QUERIES = {"op5_secret_scan": lambda spark, sf_dir: secrets(documents(spark, sf_dir), bearer_above=True)}
ORACLES: dict[str, str] = {}
