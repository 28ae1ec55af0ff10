"""Exact nearest vectors of every fiftieth row over the whole ``embeddings`` table."""

from addrweave.llm.top_k import top_k

QUERIES = {"op7_exact_top_k": lambda spark, sf_dir: top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))}
ORACLES = {
    "op7_exact_top_k": """
WITH fine AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM fine q JOIN fine c ON c.vec_id <> q.vec_id
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
""",
}
