"""Repeated byte strings removed from the whole ``documents`` table."""

from addrweave.llm.store import documents
from addrweave.llm.suffixes import without_repeated_bytes

QUERIES = {"op12_suffix_array_dedup": lambda spark, sf_dir: without_repeated_bytes(documents(spark, sf_dir), with_text=False).drop("spans", "kept")}
ORACLES = {
    "op12_suffix_array_dedup": """
WITH d AS (
    SELECT row_number() OVER () AS id, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), strings AS (
    SELECT id, i, md5(substr(h, 2 * i + 1, 400)) AS s FROM (SELECT id, h, unnest(range(0, length(h) // 2 - 199)) AS i FROM d WHERE length(h) >= 400)
), repeated AS (
    SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY s) AS n FROM strings) WHERE n > 1
), opened AS (
    SELECT id, i, coalesce(i > lag(i) OVER (PARTITION BY id ORDER BY i) + 200, true) AS new FROM repeated
), spans AS (
    SELECT id, min(i) AS lo, max(i) + 200 AS hi FROM (SELECT id, i, sum(CAST(new AS INTEGER)) OVER (PARTITION BY id ORDER BY i) AS k FROM opened) GROUP BY id, k
), pieces AS (
    SELECT id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY id ORDER BY lo), 0) AS since FROM spans
), cut AS (
    SELECT id, count(*) AS n_spans, sum(hi - lo) AS n_removed, max(hi) AS until, string_agg(substr(h, CAST(2 * since + 1 AS BIGINT), CAST(2 * (lo - since) AS BIGINT)), '' ORDER BY lo) AS head FROM pieces JOIN d USING (id) GROUP BY id
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, CAST(2 * coalesce(until, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM d LEFT JOIN cut USING (id)
""",
}
