"""Language-model scores of the whole ``documents`` table. No SQL: a trained backoff model; ``tests/llm/test_language_model.py`` has a dictionary version and held-out gains."""

from addrweave.llm.language_model import scores
from addrweave.llm.store import documents

QUERIES = {"op8_lm_scoring": lambda spark, sf_dir: scores(documents(spark, sf_dir))}
ORACLES: dict[str, str] = {}
