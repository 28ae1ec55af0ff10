"""Leaves, roots and proofs of the whole ``documents`` table."""

from addrweave.llm.manifest import proved
from addrweave.llm.store import documents

QUERIES = {"op11_merkle_manifest": lambda spark, sf_dir: proved(documents(spark, sf_dir))}
ORACLES = {
    "op11_merkle_manifest": """
WITH RECURSIVE bits AS (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM (SELECT unnest(range(256)) AS i)
), lut AS (
    SELECT list(CAST(c AS BIGINT) ORDER BY i) AS t FROM bits
), d AS (
    SELECT doc_id, source, lang, n_chars, text, coalesce(4294967295 - list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
               lambda c, b: xor(c // 256, t[CAST(xor(c % 256, b) AS BIGINT) + 1])), 1) % 5 = 0 AS bad
    FROM documents, lut
), lowered AS (
    SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM d
), digests AS (
    SELECT doc_id, source, bad, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(low) || ':' || low, '-')) AS changed
    FROM (SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
                    || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM lowered)
), placed AS MATERIALIZED (
    SELECT row_number() OVER () AS id, doc_id, source, CASE WHEN bad THEN changed ELSE leaf END AS shown, leaf, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           count(*) OVER (PARTITION BY source) AS n FROM digests
), up AS (
    SELECT 0 AS level, source, place AS p, leaf AS h, n FROM placed
    UNION ALL
    SELECT level, source, p, sha256(string_agg(h, '' ORDER BY q)), any_value((n + 15) // 16) FROM (SELECT level + 1 AS level, source, p // 16 AS p, p AS q, h, n FROM up WHERE n > 1) GROUP BY level, source, p
), subroots AS MATERIALIZED (
    SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM up WHERE n = 1
), over AS (
    SELECT 0 AS level, place AS p, subroot AS h, n FROM subroots
    UNION ALL
    SELECT level, p, sha256(string_agg(h, '' ORDER BY q)), any_value((n + 15) // 16) FROM (SELECT level + 1 AS level, p // 16 AS p, p AS q, h, n FROM over WHERE n > 1) GROUP BY level, p
), sides AS (
    SELECT s.source, s.level, s.p, coalesce(string_agg(o.h, '' ORDER BY o.p) FILTER (o.p < s.p), '') AS before, coalesce(string_agg(o.h, '' ORDER BY o.p) FILTER (o.p > s.p), '') AS after
    FROM up s JOIN up o ON o.source IS NOT DISTINCT FROM s.source AND o.level = s.level AND o.p // 16 = s.p // 16 WHERE s.n > 1 GROUP BY s.source, s.level, s.p
), top_sides AS (
    SELECT s.level, s.p, coalesce(string_agg(o.h, '' ORDER BY o.p) FILTER (o.p < s.p), '') AS before, coalesce(string_agg(o.h, '' ORDER BY o.p) FILTER (o.p > s.p), '') AS after
    FROM over s JOIN over o ON o.level = s.level AND o.p // 16 = s.p // 16 WHERE s.n > 1 GROUP BY s.level, s.p
), depth AS (
    SELECT source, max(level) AS levels FROM up GROUP BY source
), steps AS (
    SELECT id, s.level, before, after FROM placed JOIN sides s ON s.source IS NOT DISTINCT FROM placed.source AND s.p = placed.place // CAST(pow(16, s.level) AS BIGINT)
    UNION ALL
    SELECT id, levels + t.level, before, after FROM placed JOIN subroots r ON r.source IS NOT DISTINCT FROM placed.source JOIN depth ON depth.source IS NOT DISTINCT FROM placed.source
    JOIN top_sides t ON t.p = r.place // CAST(pow(16, t.level) AS BIGINT)
), proofs AS (
    SELECT id, list(before ORDER BY level) AS b, list(after ORDER BY level) AS a FROM steps GROUP BY id
), folded AS (
    SELECT id, shown AS h, 1 AS k, coalesce(len(b), 0) AS n, b, a FROM placed LEFT JOIN proofs USING (id)
    UNION ALL
    SELECT id, sha256(b[k] || h || a[k]), k + 1, n, b, a FROM folded WHERE k <= n
), root AS (
    SELECT h AS root FROM over WHERE n = 1
)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(list_zip(f.b, f.a), lambda z: z[1] || z[2]), ''), '')) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM placed JOIN folded f ON f.id = placed.id AND f.k > f.n JOIN subroots r ON r.source IS NOT DISTINCT FROM placed.source CROSS JOIN root
""",
}
