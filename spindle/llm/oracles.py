"""DuckDB SQL of the operators whose results SQL can express."""

DECONTAMINATION = r"""
WITH a AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM a CROSS JOIN sizes WHERE len(w) >= n)
), hits AS (SELECT doc_id, n, i, item_id FROM dw JOIN win USING (n, k)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT a.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM a LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

NEAR_DEDUP = r"""
WITH RECURSIVE a AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM a WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS p, y.doc_id AS q FROM s x JOIN s y ON x.k = y.k AND x.doc_id <> y.doc_id
  JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, nx.n, ny.n HAVING 100 * count(*) >= 75 * (nx.n + ny.n - count(*))
), reach(p, q) AS (SELECT p, q FROM links UNION SELECT r.p, l.q FROM reach r JOIN links l ON r.q = l.p),
low AS (SELECT p AS doc_id, min(q) AS m FROM reach GROUP BY p)
SELECT a.doc_id, coalesce(n.n, 0) AS n_shingles, least(a.doc_id, coalesce(m, a.doc_id)) AS component_id, a.doc_id <= coalesce(m, a.doc_id) AS kept
FROM a LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)
"""

SUBSTRINGS = r"""
WITH a AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
win AS (SELECT doc_id, i, substr(h, CAST(2 * i + 1 AS BIGINT), 200) AS k FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM a WHERE n >= 100)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
marked AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM late),
grouped AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM marked),
spans AS (SELECT doc_id, min(i) AS b, max(i) + 100 AS e FROM grouped GROUP BY doc_id, g),
totals AS (SELECT doc_id, sum(e - b) AS removed, count(*) AS n_spans FROM spans GROUP BY doc_id),
gaps AS (
  SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS f, b AS t FROM spans
  UNION ALL SELECT doc_id, coalesce(max(e), 0), max(n) FROM a LEFT JOIN spans USING (doc_id) GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(substr(h, CAST(2 * f + 1 AS BIGINT), CAST(2 * (t - f) AS BIGINT)), '' ORDER BY f) AS h
  FROM gaps JOIN a USING (doc_id) WHERE t > f GROUP BY doc_id)
SELECT a.doc_id, a.n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept.h, ''))) AS kept_sha256
FROM a LEFT JOIN totals USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

QUALITY_RULES = r"""
WITH a AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM a) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
), win AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM a WHERE len(w) > 2)
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM win WHERE c > 1) GROUP BY doc_id
), counted AS (
  SELECT doc_id, lang, len(w) AS n_words, length(t) AS n_chars,
    [length(regexp_replace(t, '[^a-z]', '', 'g')), length(regexp_replace(t, '[^\x20\x09-\x0D]', '', 'g')), length(regexp_replace(t, '[^.,;:!?''"()-]', '', 'g')),
     length(regexp_replace(t, '[^A-Z]', '', 'g')), length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')), length(regexp_replace(t, '[^0-9]', '', 'g')),
     length(regexp_replace(t, '[a-zA-Z0-9\x20\x09-\x0D.,;:!?''"()#*$%&|<>-]', '', 'g'))] AS chars,
    list_transform(string_split('the of and to in that der die und das ist von le la les et que une el los del por con una', ' '), lambda x: len(list_filter(w, lambda y: y = x))) AS known
  FROM a
), shared AS (
  SELECT *, list_append(known, n_words - list_sum(known)) AS words FROM counted
), flat AS (
  SELECT doc_id, lang, 'chars' AS kind, n_chars AS n, unnest(chars) AS v, unnest(range(len(chars))) AS k FROM shared
  UNION ALL SELECT doc_id, lang, 'words', n_words, unnest(words), unnest(range(len(words))) FROM shared
), refs AS (
  SELECT lang, kind, k, sum(v) / sum(sum(v)) OVER (PARTITION BY lang, kind) AS q FROM flat
  WHERE lang IN (SELECT lang FROM shared GROUP BY lang HAVING sum(n_chars) >= 2000) GROUP BY lang, kind, k
  UNION ALL SELECT NULL, kind, k, sum(v) / sum(sum(v)) OVER (PARTITION BY kind) FROM flat
  WHERE lang IS NOT NULL AND (SELECT sum(n_chars) FROM shared WHERE lang IS NOT NULL) >= 2000 GROUP BY kind, k
), near AS (
  SELECT doc_id, max(d) FILTER (kind = 'chars') AS char_distance, max(d) FILTER (kind = 'words') AS word_distance
  FROM (
    SELECT doc_id, f.kind,
      sqrt(greatest(sum(CASE WHEN v > 0 THEN v / n * log2((v / n) / ((v / n + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((v / n + q) / 2)) ELSE 0 END) / 2, 0)) AS d
    FROM flat f JOIN refs r ON f.kind = r.kind AND f.k = r.k AND f.lang IS NOT DISTINCT FROM r.lang WHERE n > 0 GROUP BY doc_id, f.kind) GROUP BY doc_id
)
SELECT s.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_chars - chars[2] AS BIGINT) AS word_chars, CAST(chars[5] AS BIGINT) AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  (n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words
    OR (n_chars >= 100 AND coalesce(char_distance, 0) > 0.28) OR (n_words >= 50 AND coalesce(word_distance, 0) > 0.45)) AS kept
FROM shared s LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN near USING (doc_id)
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM pieces GROUP BY lang),
f AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, CAST(count(*) AS HUGEINT) AS a
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces CROSS JOIN (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m)
  GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT lang, phrase, a, m, k, array_to_string(s[1:k], ' ') AS p, array_to_string(s[k + 1:m], ' ') AS q
  FROM (SELECT *, string_split(phrase, ' ') AS s, unnest(range(1, m)) AS k FROM f WHERE m > 1)
), scored AS (
  SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, n, 1000 * c.a * n // (x.a * y.a) AS score, k, c.p, c.q, c.m
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.p JOIN f y ON y.lang = c.lang AND y.phrase = c.q JOIN totals t ON t.lang = c.lang
), covered AS (
  SELECT lang, p AS phrase FROM scored WHERE k = m - 1 AND l = a UNION SELECT lang, q FROM scored WHERE k = 1 AND r = a
), best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM scored
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best b WHERE o = 1 AND NOT EXISTS (SELECT 1 FROM covered c WHERE c.lang = b.lang AND c.phrase = b.phrase)
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""
