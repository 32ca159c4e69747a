"""DuckDB SQL for the queries that SQL can express."""

from recordscope.llm.licenses import BASE_SCORE, LEAST, templates

#: Brute force over an inverted index of shingles; components by repeated minimum along links.
OP1 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(list_slice(ws, i, i + 4), ' ')) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), x AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT x.a, x.b FROM x JOIN n na ON na.doc_id = x.a JOIN n nb ON nb.doc_id = x.b WHERE 100 * c >= 75 * (na.n + nb.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id, w.doc_id = min(r.b) AS kept
FROM w JOIN reach r ON r.a = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id, n.n
"""

#: Ranks by one window instead of buckets; the level by trying each prefix of limited sources.
OP3 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number FROM d GROUP BY source
), w AS (SELECT *, [3, 1, 2][((number - 1) % 3 + 1)::INT] AS weight, sum(source_size) OVER () AS whole FROM s
), p AS (
  SELECT *, 3 * whole - coalesce(sum(4 * source_size) OVER (ORDER BY source_size / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER (ORDER BY source_size / weight, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS still FROM w
), c AS (SELECT *, 4 * source_size * still <= weight * rest AS capped FROM p
), l AS (SELECT rest, still FROM c WHERE NOT capped ORDER BY source_size / weight, number LIMIT 1
), t AS (
  SELECT source, number, source_size, CASE WHEN capped THEN 2.0::DOUBLE * source_size ELSE weight * ((SELECT rest FROM l) * 50)::DOUBLE / (100.0::DOUBLE * (SELECT still FROM l)) END AS target FROM c
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
    (('0x' || substr(md5('7:' || t.number), 1, 5))::BIGINT)::DOUBLE / 1048576 AS u,
    row_number() OVER (PARTITION BY t.number ORDER BY length(d.size::VARCHAR) * 100 + substr(rpad(d.size::VARCHAR, 2, '0'), 1, 2)::INT, md5(coalesce(d.doc_id::VARCHAR, '')), d.doc_id NULLS FIRST, d.size) AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (least(floor(u + rate * k) - floor(u + rate * (k - 1)), ceil(rate)) * size)::BIGINT AS taken FROM r
"""

#: Records compared one by one, without trees.
OP2 = r"""
WITH p AS (
  SELECT page_id // 1000 AS file, page_id, url, html,
    strlen('WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)) + strlen(coalesce(html, '')) + 4 AS length
  FROM pages
), r AS (
  SELECT *, row_number() OVER (PARTITION BY file ORDER BY page_id, url, html) - 1 AS record_no,
    coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id, url, html ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
    file % 3 = 1 AND page_id % 1000 >= 900 AS lost, page_id % 97 = 13 AND contains(coalesce(html, ''), 'e') AS altered FROM p
)
SELECT file, record_no, start::BIGINT AS "start", (start + length)::BIGINT AS "end", CASE WHEN lost THEN 'missing' ELSE 'changed' END AS status FROM r WHERE lost OR altered
"""

#: Cosines of all pairs of a label.
OP10 = r"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), ok AS (
  SELECT * FROM v WHERE e IS NOT NULL AND label IS NOT NULL AND len(e) > 0 AND list_aggregate(list_transform(e, lambda x: coalesce(isfinite(x), false)), 'bool_and')
    AND list_aggregate(list_transform(e, lambda x: x <> 0), 'bool_or')
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), n AS (SELECT a, count(*) AS n FROM links GROUP BY a
), reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, min(r.b) AS component_id, v.vec_id = min(r.b) AS kept
FROM v JOIN reach r ON r.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id GROUP BY v.vec_id, n.n
"""

#: Scores of all anchors; whole numbers of this size are exact as doubles.
OP11 = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND coalesce(list_aggregate(list_transform(embedding, lambda x: coalesce(isfinite(x), false)), 'bool_and'), true)
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
), n AS (
  SELECT p.anchor_id, p.other AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY s.score DESC, s.other)::INT AS rank, s.other AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same WHERE 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
)
SELECT * FROM n WHERE rank <= 5
"""

#: All grams of all pieces are counted; longer phrases are tried for each drop.
OP12 = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p
), t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang
), g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: list_slice(ws, i, i + k - 1))) AS ph FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) x WHERE len(ws) >= k
), f AS MATERIALIZED (SELECT lang, k, ph, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100
), inside AS (
  SELECT DISTINCT q.lang, p.ph FROM f q JOIN f p ON p.lang = q.lang AND p.k > 1 AND p.k < q.k AND 100 * q.f >= 100 * p.f
    AND list_bool_or(list_transform(range(1, q.k - p.k + 2), lambda i: list_slice(q.ph, i, i + p.k - 1) = p.ph))
), c AS (SELECT f.* FROM f WHERE k > 1 AND (lang, ph) NOT IN (SELECT (lang, ph) FROM inside)
), s AS (
  SELECT c.lang, c.ph, c.f AS a, x.cut, l.f AS l, r.f AS r, t.n, ((1000::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM c JOIN (SELECT unnest([1, 2, 3, 4]) AS cut) x ON x.cut < c.k JOIN f l ON l.lang = c.lang AND l.ph = list_slice(c.ph, 1, x.cut) JOIN f r ON r.lang = c.lang AND r.ph = list_slice(c.ph, x.cut + 1, c.k) JOIN t ON t.lang = c.lang
), b AS (SELECT *, array_to_string(ph, ' ') AS phrase FROM s QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, cut) = 1
), o AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM b)
SELECT * FROM o WHERE rank <= 2000
"""


def _templates() -> str:
    rows = [f"('{label}', {words}, {key}, {at}, {str(base).lower()})" for label, words, key, at, base in templates()]
    return "(VALUES " + ", ".join(rows) + ") t(label, words, key, key_at, base)"


#: Every word of every text is tried as the first of each key phrase.
OP13 = rf"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), p AS (
  SELECT rid, ws, t.*, unnest(list_filter(range(len(ws)), lambda i: ws[i + 1] = t.key[1] AND list_slice(ws, i + 1, i + len(t.key)) = t.key)) AS i FROM w JOIN {_templates()} ON list_has_all(ws, t.key)
), m AS (
  SELECT rid, label, base, i, len(list_filter(range(len(words)), lambda o: i - key_at + o >= 0 AND coalesce(ws[i - key_at + o + 1] = words[o + 1], false))) AS same, len(words) AS n FROM p
), f AS (SELECT *, same::DOUBLE / n AS share FROM m WHERE 100 * same >= {LEAST} * n
), g AS (
  SELECT rid, count(*) FILTER (base) AS n_base, min(i) FILTER (base) AS first_word, max(i) FILTER (base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) FILTER (NOT base) AS share, string_agg(label || ':' || i, ',' ORDER BY i, label, base) AS places FROM f GROUP BY rid
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  greatest(coalesce(share, 0::DOUBLE), CASE WHEN n_base > 0 THEN {BASE_SCORE}::DOUBLE ELSE 0::DOUBLE END) AS score, coalesce(places, '') AS places
FROM w LEFT JOIN g USING (rid)
"""
