"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

_DIGIT = "ascii(substr(md5(list || ':' || entry), {}, 1)) % 16"

SQL["op5_urlfilter"] = rf"""
WITH captured AS (
  SELECT page_id, url, 1704067200 + (page_id * 7919) % (120 * 86400) AS fetched,
         nullif(rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#\s]*@)?([^/:?#@\s]+)', 1)), '.'), '') AS host,
         nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]+/([^/?#\s]+)', 1), '') AS segment
  FROM pages),
named AS (
  SELECT DISTINCT 'spam' AS list, host AS entry, 8 AS share FROM captured WHERE host IS NOT NULL
  UNION SELECT DISTINCT 'adult', regexp_extract(host, '([^.]+\.[^.]+)$', 1), 6 FROM captured
    WHERE host IS NOT NULL AND regexp_extract(host, '([^.]+\.[^.]+)$', 1) <> ''
  UNION SELECT DISTINCT 'allow', host || '/' || segment, 5 FROM captured WHERE host IS NOT NULL AND segment IS NOT NULL),
life AS (
  SELECT list, entry, 1704067200 + 86400 * (2 * ({_DIGIT.format(2)})) AS born, 1 + {_DIGIT.format(3)} AS pace
  FROM named WHERE {_DIGIT.format(1)} < share),
active AS (
  SELECT list, entry, born AS since, born + 86400 * 2 * pace AS until FROM life
  UNION ALL SELECT list, entry, born + 86400 * 5 * pace, NULL FROM life),
names AS (
  SELECT page_id, fetched, host AS key, 1000 AS depth FROM captured WHERE host IS NOT NULL
  UNION ALL SELECT page_id, fetched, host || '/' || segment, 1001 FROM captured WHERE host IS NOT NULL AND segment IS NOT NULL
  UNION ALL SELECT page_id, fetched, array_to_string(list_slice(string_split(host, '.'), i, 9999), '.'), 1001 - i
    FROM captured, range(2, 1000) r(i) WHERE i < len(string_split(host, '.'))),
hits AS (
  SELECT n.page_id, n.fetched, a.list, a.entry,
         row_number() OVER (PARTITION BY n.page_id ORDER BY n.depth DESC, (a.list <> 'allow')::INT, a.list, a.entry) AS place,
         count(*) OVER (PARTITION BY n.page_id) AS n_active
  FROM names n JOIN active a ON n.key = a.entry AND n.fetched >= a.since AND (a.until IS NULL OR n.fetched < a.until))
SELECT c.page_id, c.fetched, coalesce(h.list <> 'allow', false) AS blocked, h.list, h.entry, coalesce(h.n_active, 0) AS n_active
FROM captured c LEFT JOIN hits h ON c.page_id = h.page_id AND h.place = 1
"""

_WORDY = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""".replace("'", "''")
_MIXED = " AND ".join(f"regexp_matches(right(part, 40), '{c}')" for c in ("[a-z]", "[A-Z]", "[0-9]"))
_KINDS = [("assign", _WORDY, 2, "length(part) >= 6", 1), ("access", "AKIA[A-Z0-9]+", 0, "length(part) >= 20", 2),
          ("hex", "[0-9a-f]{24,}", 0, "true", 3),
          # a run of exactly 40, or the last 40 of a run of a key's own characters that stand at its start or behind a slash
          ("key", "[A-Za-z0-9+/=_-]{40,}", 0, f"length(part) = 40 AND {_MIXED}", 4),
          ("key", "[A-Za-z0-9+/]{40,}", 0, f"(length(part) = 40 OR substr(part, length(part) - 40, 1) = '/') AND {_MIXED}", 4),
          ("endpoint", r"https?://[A-Za-z0-9.-]+(:[0-9]+)?(/[A-Za-z0-9_./?&=%#-]*)?", 0, "true", 5)]
_FOUND = "\nUNION ".join(f"""
  SELECT doc_id, '{kind}' AS kind, {number} AS number, stop - {"40" if kind == "key" else "length(hit)"} AS start, stop AS "end" FROM (
    SELECT doc_id, hit, part, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM (
      SELECT doc_id, unnest(range(1, len(hits) + 1)) AS i, unnest(hits) AS hit, unnest(parts) AS part,
             unnest(list_slice(gaps, 1, len(hits))) AS gap FROM (
        SELECT doc_id, regexp_extract_all(text, '{pattern}') AS hits, regexp_extract_all(text, '{pattern}', {group}) AS parts,
               string_split_regex(text, '{pattern}') AS gaps FROM documents WHERE regexp_matches(text, '{pattern}'))))
  WHERE {test}""" for kind, pattern, group, test, number in _KINDS)

SQL["op6_secrets"] = f"""
WITH found AS ({_FOUND}),
reported AS (
  SELECT * FROM found WHERE number <= 3
  UNION ALL SELECT * FROM found w WHERE number > 3 AND EXISTS (
    SELECT 1 FROM found p WHERE p.doc_id = w.doc_id AND w.start <= p."end" + 200 AND p.start <= w."end" + 200
      AND (p.kind = 'access' OR (p.kind = 'assign' AND w.kind = 'endpoint')))),
listed AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, number) FILTER (number <= 3) AS base,
         string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, number) AS spans
  FROM reported GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN listed USING (doc_id)
"""

SQL["op3_topk"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

SQL["op4_jaccard"] = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS gram FROM split),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, r.component_id,
       (SELECT count(*) FROM links l WHERE l.x = d.doc_id) AS n_links
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)
"""

SQL["op12_negatives"] = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM whole a JOIN whole c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, row_number() OVER (
         PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""

SQL["op13_quality"] = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM split),
twice AS (
  SELECT doc_id, i FROM places
  QUALIFY count(*) OVER (PARTITION BY doc_id, list_slice(w, i, i + 7)) > 1),
again AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(0, 8) r(j) GROUP BY doc_id),
counted AS (
  SELECT s.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(a.n, 0)::BIGINT AS n_repeat_words,
         len(l) AS n_lines, len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS n_lettered,
         len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*(- |\* |•)'))) AS n_items,
         len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipses
  FROM split s LEFT JOIN again a USING (doc_id)),
base AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 12 * n_words OR 100 * n_lettered < 80 * n_words
            OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines OR 100 * n_items > 90 * n_lines
            OR 100 * n_ellipses > 30 * n_lines) AS kept
FROM base
"""

SQL["op11_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
runs AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(list_slice(w, i, i + size - 1), ' '))) AS phrase
  FROM split, range(1, 5) s(size) WHERE len(w) >= size),
freq AS (SELECT lang, size, phrase, count(*) AS f FROM runs GROUP BY ALL),
words AS (SELECT lang, sum(f)::BIGINT AS n FROM freq WHERE size = 1 GROUP BY lang),
often AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, f AS a FROM freq WHERE f >= 30),
inside AS (
  SELECT DISTINCT p.lang, p.phrase FROM often p
  JOIN (SELECT lang, a, unnest(list_transform(range(1, size - m + 2), lambda i: array_to_string(list_slice(w, i, i + m - 1), ' '))) AS phrase
        FROM often, range(2, 4) r(m) WHERE m < size) q
  ON p.lang = q.lang AND p.phrase = q.phrase AND 100 * q.a::HUGEINT >= 80 * p.a::HUGEINT),
cuts AS (
  SELECT p.lang, p.phrase, p.a, k, x.f AS l, y.f AS r, (2000000 * p.a::HUGEINT // (x.f + y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM often WHERE size > 1) p
  JOIN freq x ON x.lang = p.lang AND x.phrase = array_to_string(list_slice(w, 1, k), ' ')
  JOIN freq y ON y.lang = p.lang AND y.phrase = array_to_string(list_slice(w, k + 1, p.size), ' ')),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank, w.phrase, a, l, r, n, score
FROM weakest w JOIN words USING (lang) ANTI JOIN inside i ON i.lang = w.lang AND i.phrase = w.phrase
QUALIFY rank <= 2000
"""
