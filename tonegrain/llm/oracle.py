"""Expected results of the training-data queries as SQL, where SQL can state them."""

from __future__ import annotations

_LINKED = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_ORACLE = {
    "op3_ngram_jaccard_join": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) END AS s FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id < y.doc_id
  GROUP BY x.doc_id, y.doc_id HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))),
{_LINKED}
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(l.b, s.doc_id)) AS component_id
FROM sets s LEFT JOIN least l ON l.a = s.doc_id""",
    "op4_line_dedup": r"""
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM split),
solid AS (SELECT doc_id, line, i FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
runs AS (
  SELECT doc_id, i AS i1, lead(i, 1) OVER w AS i2, lead(i, 2) OVER w AS i3,
    line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS run
  FROM solid WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
firsts AS (
  SELECT run, first(doc_id ORDER BY doc_id, i1) AS d, first(i1 ORDER BY doc_id, i1) AS f1, first(i3 ORDER BY doc_id, i1) AS f3
  FROM runs WHERE i3 IS NOT NULL GROUP BY run),
later AS (SELECT r.*, f.d, f.f3 FROM runs r JOIN firsts f USING (run) WHERE r.doc_id <> f.d OR r.i1 <> f.f1),
gone AS (
  SELECT DISTINCT doc_id, i FROM (SELECT doc_id, unnest([i1, i2, i3]) AS i, d, f3 FROM later)
  WHERE doc_id <> d OR i > f3),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL) AS text, count(g.i) AS n_removed
  FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id)
SELECT s.doc_id, CASE WHEN s.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(k.n_removed, 0)::BIGINT AS n_removed
FROM split s LEFT JOIN kept k ON k.doc_id = s.doc_id""",
    "op6_vector_range_join": rf"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS norm FROM v),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.vec_id < y.vec_id AND len(x.e) = len(y.e)
  WHERE list_inner_product(x.e, y.e) / (x.norm * y.norm) >= 0.9),
{_LINKED},
counts AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(l.b, e.vec_id)) AS component_id,
  least(e.vec_id, coalesce(l.b, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counts c ON c.a = e.vec_id LEFT JOIN least l ON l.a = e.vec_id""",
    "op10_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS keeper FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN strlen(html) >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN strlen(html) >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
FROM g""",
    "op11_benchmark_decontamination": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
kinds AS (SELECT DISTINCT k, p FROM windows),
starts AS (
  SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS p
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM kinds) WHERE len(w) >= k)),
found AS (SELECT doc_id, k, s, p FROM starts SEMI JOIN kinds USING (k, p)),
hits AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(s, s + k)) AS i FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, sha256(string_agg(i, ',' ORDER BY i)) AS h
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found JOIN windows USING (k, p)) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
  coalesce(i.h, sha256('')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hits h ON h.doc_id = d.doc_id LEFT JOIN items i ON i.doc_id = d.doc_id""",
    "op12_collocations": r"""
WITH p AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
total AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, k, w[i:i + k - 1] AS g
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, g, count(*) AS a FROM grams GROUP BY lang, k, g HAVING count(*) >= 100),
cand AS (
  SELECT * FROM f s WHERE k >= 2 AND NOT EXISTS (
    SELECT 1 FROM f b WHERE b.lang = s.lang AND b.k > s.k AND 100 * b.a >= 100 * s.a
      AND contains(' ' || array_to_string(b.g, ' ') || ' ', ' ' || array_to_string(s.g, ' ') || ' '))),
cuts AS (SELECT lang, k, g, a, unnest(range(1, k)) AS c FROM cand),
scored AS (
  SELECT c.lang, array_to_string(c.g, ' ') AS phrase, c.a, c.c, x.a AS l, y.a AS r, t.n,
    (1000::HUGEINT * c.a * t.n) // (x.a::HUGEINT * y.a) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = c.g[1:c.c] JOIN f y ON y.lang = c.lang AND y.g = c.g[c.c + 1:c.k]
  JOIN total t ON t.lang = c.lang),
least_cut AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
SELECT lang, row_number() OVER w AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM least_cut WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER w <= 2000""",
}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
