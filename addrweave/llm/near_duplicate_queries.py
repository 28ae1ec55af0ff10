"""Near-duplicate groups over the whole ``documents`` table.

No SQL: exact similarities of all pairs need a self join on shingles, too slow on whole tables; ``tests/llm/test_near_duplicates.py`` compares with brute force.
"""

from addrweave.llm.near_duplicates import near_duplicates
from addrweave.llm.store import documents

QUERIES = {"op10_minhash_near_dedup": lambda spark, sf_dir: near_duplicates(documents(spark, sf_dir))}
ORACLES: dict[str, str] = {}
