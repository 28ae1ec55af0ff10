"""Repeated passages removed from the whole ``documents`` table."""

from addrweave.llm.store import documents
from addrweave.llm.substrings import without_repetitions

QUERIES = {"op3_substring_dedup": lambda spark, sf_dir: without_repetitions(documents(spark, sf_dir), with_text=False).drop("kept")}
ORACLES = {
    "op3_substring_dedup": r"""
WITH d AS (
    SELECT doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS seq FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)
), again AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY seq ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM again
), words AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), marked AS (
    SELECT words.doc_id, word, words.p, gone.p IS NOT NULL AS cut FROM words LEFT JOIN gone USING (doc_id, p)
), summed AS (
    SELECT doc_id, count(*) FILTER (cut) AS n, coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT cut), '') AS kept FROM marked GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN summed USING (doc_id)
""",
}
