"""DuckDB SQL for the queries that SQL can express.

Not expressed: packing, token counts and toxicity (tokenizers, a fitted model), near-dedup, repeated strings
and license windows (too slow on whole tables), line rules (back references), sharding (checksums). The
tests hold those against plain Python.
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
),
keyed AS (
  SELECT *, translate(trim(line, {_BLANKS}), '{_UPPER}', '{_LOWER}') AS key FROM lines
),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
marked AS (
  SELECT k.*, r.keeper IS NOT NULL AND k.doc_id <> r.keeper AS gone
  FROM keyed k LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, CAST(count_if(gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DECONTAMINATION = f"""
WITH worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS words
  FROM documents
),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS words
  FROM benchmark
),
grams AS (
  SELECT DISTINCT item, size, words[n : n + size - 1] AS gram
  FROM (
    SELECT item, words, size, unnest(range(1, len(words) - size + 2)) AS n
    FROM (SELECT *, least(10, len(words)) AS size FROM items WHERE len(words) > 0)
  )
),
sizes AS (SELECT DISTINCT size FROM grams),
windows AS (
  SELECT doc_id, size, n, words[n : n + size - 1] AS gram
  FROM (
    SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS n
    FROM worded CROSS JOIN sizes WHERE len(words) >= size
  )
),
hits AS (
  SELECT w.doc_id, w.n, w.size, g.item FROM windows w JOIN grams g ON w.gram = g.gram AND w.size = g.size
),
hit_words AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(n, n + size)) AS place FROM hits) GROUP BY doc_id
),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS item_list
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(item_list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM worded LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""

ORACLES: dict[str, str] = {
    "op1_line_dedup": LINE_DEDUP,
    "op6_benchmark_decontamination": DECONTAMINATION,
}
