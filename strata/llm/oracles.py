"""DuckDB SQL of the operators that SQL can express, over whole tables and whole texts.

Each statement follows the contract directly (every window is listed and compared), not the operator's method.
"""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_ALNUM_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

MINHASH_FOREST = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce({_SPACE_WORDS.format(_LOWER.format('text'))}, []) AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:least(i + 4, len(w))], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM texts WHERE len(w) > 0) s),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT p.a, p.b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
        FROM shingles x JOIN shingles y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN sizes sa ON sa.doc_id = p.a JOIN sizes sb ON sb.doc_id = p.b
  WHERE 100 * common >= 75 * (sa.n + sb.n - common)),
reached AS (
  SELECT a, b FROM links
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
least_reached AS (SELECT a AS doc_id, min(b) AS other FROM reached GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(least(doc_id, other), doc_id) AS component_id,
       doc_id <= coalesce(other, doc_id) AS kept
FROM texts LEFT JOIN sizes USING (doc_id) LEFT JOIN least_reached USING (doc_id)"""

SUFFIX_DEDUP = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
-- 500 starts a block, each block with the bytes that its last string needs: short strings are cheap to cut
blocks AS (SELECT doc_id, b, substr(hx, 1000 * b + 1, 1398) AS hx
           FROM (SELECT doc_id, hx, unnest(range((length(hx) + 999) // 1000)) AS b FROM texts) s),
bytes AS (SELECT doc_id, 500 * b + i AS p, substr(hx, 2 * i + 1, 2) AS octet,
                 CASE WHEN 2 * i + 400 <= length(hx) THEN md5(substr(hx, 2 * i + 1, 400)) END AS h
          FROM (SELECT doc_id, b, hx, unnest(range(least(500, length(hx) // 2))) AS i FROM blocks) s),
repeated AS (SELECT h FROM bytes WHERE h IS NOT NULL GROUP BY h HAVING count(*) > 1),
marked AS (SELECT doc_id, p, octet,
                  bool_or(coalesce(h IN (SELECT h FROM repeated), false))
                    OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS gone
           FROM bytes),
runs AS (SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY p) AS opens FROM marked)
SELECT doc_id, count(p) AS n_bytes, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
       sha256(unhex(coalesce(string_agg(octet, '' ORDER BY p) FILTER (NOT gone), ''))) AS kept_sha256
FROM texts LEFT JOIN runs USING (doc_id) GROUP BY doc_id"""

SUBSTRING_DEDUP = f"""
WITH texts AS (SELECT doc_id, coalesce({_SPACE_WORDS.format('text')}, []) AS w FROM documents),
places AS (SELECT doc_id, p, w[p] AS word,
                  CASE WHEN p + 49 <= len(w) THEN md5(array_to_string(w[p:p + 49], ' ')) END AS h
           FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM texts) s),
firsts AS (SELECT h, min(doc_id) AS first_doc FROM places WHERE h IS NOT NULL GROUP BY h),
marked AS (SELECT doc_id, p, word,
                  bool_or(coalesce(first_doc < doc_id, false))
                    OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
           FROM places LEFT JOIN firsts USING (h))
SELECT doc_id, count(p) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM texts LEFT JOIN marked USING (doc_id) GROUP BY doc_id"""

DECONTAMINATE = f"""
WITH texts AS (SELECT doc_id, coalesce({_ALNUM_WORDS.format(_LOWER.format('text'))}, []) AS w FROM documents),
items AS (SELECT item_id, {_ALNUM_WORDS.format(_LOWER.format('text'))} AS w FROM benchmark),
phrases AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
            FROM (SELECT item_id, w, least(len(w), 13) AS k, unnest(range(1, greatest(len(w) - 11, 2))) AS i
                  FROM items WHERE len(w) > 0) s),
windows AS (SELECT doc_id, p, k, array_to_string(w[p:p + k - 1], ' ') AS phrase
            FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
                  FROM texts, (SELECT DISTINCT k FROM phrases) ks) s),
found AS (SELECT doc_id, p, k, item_id FROM windows JOIN phrases USING (k, phrase)),
hits AS (SELECT doc_id, count(DISTINCT q) AS n_hit
         FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM (SELECT DISTINCT doc_id, p, k FROM found) f) c
         GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) f GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM texts LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)"""

HARD_NEGATIVES = """
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
         [floor(256 * CAST(c AS DOUBLE)) FOR c IN embedding] AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
scores AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM kept a JOIN kept b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT * FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, r) <= 5),
negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY n.score DESC, n.vec_id NULLS LAST, n.r) AS rank
  FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5"""

SQL: dict[str, str] = {
    "op2_minhash_forest": MINHASH_FOREST,
    "op3_suffix_dedup": SUFFIX_DEDUP,
    "op4_substring_dedup": SUBSTRING_DEDUP,
    "op8_decontaminate": DECONTAMINATE,
    "op11_hard_negatives": HARD_NEGATIVES,
}
