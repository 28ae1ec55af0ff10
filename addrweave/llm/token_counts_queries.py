"""Token counts of the whole ``documents`` table. No SQL: a segmentation of every pre-token; ``tests/llm/test_token_counts.py`` compares with two other ways."""

import public_tokenizers

from addrweave.llm.store import documents
from addrweave.llm.token_counts import token_counts
from addrweave.llm.tokens import vocabulary

QUERIES = {"op9_trie_token_counts": lambda spark, sf_dir: token_counts(documents(spark, sf_dir), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)}
ORACLES: dict[str, str] = {}
