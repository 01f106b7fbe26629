"""The queries in SQL for DuckDB, where SQL can say them."""

from __future__ import annotations

# White space, and the letters that lower-casing changes.
WORD = "[^\\x20\\x09-\\x0D]"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT doc_id, s, hash(substr(h, 2 * s + 1, 200)) AS k
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS s FROM d)
),
later AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM w
  ) WHERE n > 1
),
islands AS (
  SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS island FROM (
    SELECT doc_id, s,
      CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS fresh
    FROM later
  )
),
spans AS (SELECT doc_id, island, min(s) AS a, max(s) + 100 AS b FROM islands GROUP BY ALL),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS g, a, b FROM spans
),
cut AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS tail,
    string_agg(substr(h, 2 * g + 1, 2 * (a - g)), '' ORDER BY a) AS front
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

OP2 = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
),
words AS (SELECT r, regexp_extract_all(t, '{WORD}+') AS w FROM d),
tri AS (
  SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words)
),
twice AS (
  SELECT r, i FROM tri
  QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1
),
repeats AS (
  SELECT r, count(DISTINCT p) AS n
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
),
lines AS (
  SELECT r, doc_id, source, l, length(l) AS n FROM (
    SELECT r, doc_id, source, trim(regexp_replace(regexp_replace(lower(unnest(
      string_split(t, chr(10)))), '[0-9]', '0', 'g'), '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ') AS l
    FROM d
  ) WHERE l <> ''
),
hosts AS (SELECT source, count(DISTINCT doc_id) AS docs FROM d GROUP BY source),
common AS (
  SELECT h.source, l FROM (
    SELECT source, l, count(DISTINCT doc_id) AS n FROM lines GROUP BY ALL
  ) c JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source
  WHERE n > 10 AND (n > 0.1 * docs OR n > 1000)
),
shares AS (
  SELECT r, sum(CASE WHEN c.l IS NULL THEN 0 ELSE n END) / sum(n) AS share
  FROM lines x LEFT JOIN common c ON x.l = c.l AND x.source IS NOT DISTINCT FROM c.source
  GROUP BY r
),
figures AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, coalesce(share, 0.0) AS removed_share
  FROM (
    SELECT r, doc_id, t,
      list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS ls FROM d
  ) JOIN words USING (r) LEFT JOIN repeats USING (r) LEFT JOIN shares USING (r)
),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    1 - removed_share < 0.5 AS depleted
  FROM figures
)
SELECT *, NOT base_failed AND NOT depleted AS kept FROM judged
"""

OP5 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{WORD}+') AS w
  FROM documents
),
sets AS (
  SELECT DISTINCT doc_id,
    CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
    ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0
  )
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * k >= 75 * (p.n + q.n - k)
),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a
),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""

OP8 = f"""
WITH rules(h, p, verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
),
urls AS (
  SELECT row_number() OVER () AS r, page_id,
    {LOWER.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
)
SELECT page_id, host, path, h || p AS rule, coalesce(verdict, 'allow') AS verdict
FROM urls LEFT JOIN rules
  ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
QUALIFY row_number() OVER (
  PARTITION BY r ORDER BY length(h) + length(p) DESC, length(h) DESC, verdict DESC, h
) = 1
"""

INTEGERS = """
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
"""

OP12 = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  {INTEGERS} AND label IS NOT NULL AND vec_id IS NOT NULL
),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS same,
    CAST(list_inner_product(a.e, r.e) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
    AS INTEGER) AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

ROUND = """
a{n} AS MATERIALIZED (
  SELECT vec_id, e, c AS cluster,
    CAST(list_inner_product(e, e) - 2 * list_inner_product(e, m) + list_inner_product(m, m)
      AS BIGINT) AS distance
  FROM k, c{n} QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, c) = 1
),
c{next} AS MATERIALIZED (
  SELECT c, coalesce(mean, m) AS m FROM c{n} LEFT JOIN (
    SELECT cluster AS c, list(mean ORDER BY place) AS mean FROM (
      SELECT cluster, place, floor(sum(x) / count(*)) AS mean
      FROM (SELECT cluster, unnest(e) AS x, unnest(range(64)) AS place FROM a{n})
      GROUP BY ALL
    ) GROUP BY cluster
  ) USING (c)
)
"""

OP13 = f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, {INTEGERS}
),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), e) - 1 AS c, e AS m FROM k
  WHERE vec_id IS NOT NULL QUALIFY c < 40
),
{",".join(ROUND.format(n=n, next=n + 1) for n in range(5))},
{ROUND.format(n=5, next=6)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(m, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM a5 JOIN c5 ON c = cluster
"""

SQL = {
    "op1_suffix_dedup": OP1,
    "op2_quality_rules": OP2,
    "op5_near_dedup": OP5,
    "op8_url_filters": OP8,
    "op12_hard_negatives": OP12,
    "op13_centroid_clustering": OP13,
}
