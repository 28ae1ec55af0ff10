"""Documents that contain benchmark items, over the whole tables.

No SQL: BM25 passages of all documents against all items are a self join on words; ``tests/llm/test_decontamination.py`` compares with brute force.
"""

from addrweave.llm.decontamination import WHOLE, contaminated
from addrweave.llm.store import documents

QUERIES = {"op1_benchmark_decontamination": lambda spark, sf_dir: contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), WHOLE)}
ORACLES: dict[str, str] = {}
