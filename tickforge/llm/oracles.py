"""DuckDB SQL for the training-data queries that SQL can express on whole tables."""

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i + 1 : i + 20], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(len(ws) - 19)) AS i FROM w WHERE len(ws) >= 20)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
cov AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, i + unnest(range(20)) AS p FROM rep) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN ps IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(ps, i - 1)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id
"""

_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP6 = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS ws FROM documents),
b AS (SELECT DISTINCT item_id, ws, least(10, len(ws)) AS n FROM (SELECT item_id, {_ITEM_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0 AND item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, n, array_to_string(ws[k + 1 : k + n], ' ') AS key FROM (SELECT item_id, n, ws, unnest(range(len(ws) - n + 1)) AS k FROM b)),
dw AS (SELECT doc_id, n, s, array_to_string(ws[s + 1 : s + n], ' ') AS key FROM (SELECT doc_id, ws, n, unnest(range(len(ws) - n + 1)) AS s FROM d, (SELECT DISTINCT n FROM b) WHERE len(ws) >= n)),
hit AS (SELECT doc_id, s, n, item_id FROM dw JOIN bw USING (n, key)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, s + unnest(range(n)) AS p FROM hit) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN ids ON d.doc_id = ids.doc_id
"""

OP9 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[k + 1 : k + 5], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(greatest(1, len(ws) - 4))) AS k FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * o >= 80 * (p.n + q.n - o)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, least(w.doc_id, min(reach.b)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN reach ON reach.a = w.doc_id GROUP BY w.doc_id
"""

ORACLES = {"op4_substring_dedup": OP4, "op6_benchmark_decontamination": OP6, "op9_ngram_jaccard_join": OP9}
