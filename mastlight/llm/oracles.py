"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = f"regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP4 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
b AS (SELECT item_id, {WORDS} AS w FROM benchmark),
win AS (
    SELECT DISTINCT item_id, list_slice(w, i, i + least(10, len(w)) - 1) AS g
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(g) AS n FROM win),
places AS (
    SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS g
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, n, i FROM places JOIN win USING (g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP7 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""


OP11 = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
counts AS (
    SELECT lang, g, count(*) AS f
    FROM (SELECT lang, list_slice(w, i, i + m - 1) AS g
        FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) AS s(m) WHERE len(w) >= m))
    GROUP BY lang, g HAVING count(*) >= 30),
cuts AS (
    SELECT lang, g, f AS a, list_slice(g, 1, k) AS first, list_slice(g, k + 1, len(g)) AS rest, k
    FROM (SELECT lang, g, f, unnest(range(1, len(g))) AS k FROM counts WHERE len(g) > 1)),
scored AS (
    SELECT c.lang, c.g, c.a, x.f AS l, y.f AS r, c.k, 2000000::HUGEINT * c.a // (x.f + y.f) AS score
    FROM cuts c JOIN counts x ON x.lang = c.lang AND x.g = c.first JOIN counts y ON y.lang = c.lang AND y.g = c.rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inside AS (
    SELECT lang, list_slice(g, i, i + m - 1) AS g, max(f) AS longest
    FROM (SELECT lang, g, f, m, unnest(range(1, len(g) - m + 2)) AS i FROM counts, (VALUES (2), (3)) AS s(m) WHERE len(g) > m)
    GROUP BY ALL),
kept AS (
    SELECT best.* FROM best LEFT JOIN inside ON inside.lang = best.lang AND inside.g = best.g
    WHERE longest IS NULL OR 100::HUGEINT * longest < 80::HUGEINT * a)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, array_to_string(g, ' ') AS phrase,
        row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank FROM kept)
    JOIN totals USING (lang)
WHERE rank <= 2000
"""


def llm_oracles() -> dict[str, str]:
    return {"op4_decontaminate": OP4, "op7_topk": OP7, "op11_collocations": OP11}
