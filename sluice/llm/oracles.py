"""DuckDB SQL for the operators whose whole result plain SQL can express: the
definitions spelled out word by word, with none of the operators' methods."""

UPPER, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SUBSTRING_DEDUP = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
words AS (SELECT rid, doc_id, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM docs),
runs AS (
  SELECT rid, doc_id, n, pos, word,
    md5(string_agg(word, ' ') OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) AS win
  FROM words),
sources AS (SELECT win, min(doc_id) AS source FROM runs WHERE pos + 49 <= n GROUP BY win),
judged AS (
  SELECT rid, pos, word, max(CASE WHEN pos + 49 <= n AND source < doc_id THEN 1 ELSE 0 END)
    OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM runs LEFT JOIN sources USING (win)),
kept AS (
  SELECT rid, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE gone = 0) AS kept FROM judged GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)
"""
DECONTAMINATE = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '@U', '@L'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
items AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item,
    regexp_extract_all(translate(coalesce(text, ''), '@U', '@L'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
item_words AS (SELECT item, ws, least(10, len(ws)) AS k, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM items),
item_runs AS (SELECT item, k, len(ws) AS n, pos,
    string_agg(word, ' ') OVER (PARTITION BY item, ws ORDER BY pos ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS win FROM item_words),
windows AS (SELECT DISTINCT item, k, win FROM item_runs WHERE pos + k - 1 <= n),
words AS (SELECT rid, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM docs),
runs AS (SELECT rid, n, pos, k, string_agg(word, ' ')
    OVER (PARTITION BY rid, k ORDER BY pos ROWS BETWEEN CURRENT ROW AND (k - 1) FOLLOWING) AS win
  FROM words CROSS JOIN (SELECT DISTINCT k FROM windows)),
hits AS (SELECT rid, pos, k, item FROM runs JOIN windows USING (k, win) WHERE pos + k - 1 <= n),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(pos, pos + k)) AS p FROM hits) GROUP BY rid),
found AS (SELECT rid, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS ids FROM hits GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (rid) LEFT JOIN found USING (rid)
""".replace("@U", UPPER).replace("@L", LOW)
