"""Packing of the whole ``documents`` table. No SQL: SQL has no tokenizer; ``tests/llm/test_packing.py`` checks pieces and sequences."""

from addrweave.llm.packing import packed
from addrweave.llm.store import documents
from addrweave.llm.tokens import vocabulary

QUERIES = {"op6_best_fit_packing": lambda spark, sf_dir: packed(documents(spark, sf_dir), vocabulary())}
ORACLES: dict[str, str] = {}
