"""Token files of the whole ``documents`` table, written and read back. No SQL: SQL has no tokenizer; ``tests/llm/test_token_files.py`` has exact round trips."""

from addrweave.llm.store import documents
from addrweave.llm.token_files import read_tokens, write_tokens
from addrweave.llm.tokens import vocabulary

QUERIES = {"op4_simple8b_token_files": lambda spark, sf_dir: read_tokens(write_tokens(documents(spark, sf_dir), vocabulary()))}
ORACLES: dict[str, str] = {}
