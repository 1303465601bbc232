"""DuckDB SQL of the operators that SQL can express, by their contracts' rules and not by their methods."""

#: links from all pairs that share a shingle, components by transitive closure
OP1 = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
  s AS (SELECT r, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)), lambda k: hash(w[k:k + 4])))) AS h FROM d WHERE len(w) > 0),
  n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
  p AS (SELECT a.r AS u, b.r AS v, count(*) AS inter FROM s a JOIN s b ON a.h = b.h AND a.r <> b.r GROUP BY ALL),
  e AS (SELECT u, v FROM p JOIN n x ON x.r = u JOIN n y ON y.r = v WHERE 100 * inter >= 80 * (x.n + y.n - inter)),
  c AS (SELECT r AS u, r AS v FROM n UNION SELECT c.u, e.v FROM c JOIN e ON e.u = c.v),
  m AS (SELECT c.u AS r, min(t.doc_id) AS component_id FROM c JOIN d t ON t.r = c.v GROUP BY c.u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, CASE WHEN n.n IS NULL THEN d.doc_id ELSE m.component_id END AS component_id
FROM d LEFT JOIN n USING (r) LEFT JOIN m USING (r)
"""

#: every item laid along every text at every shift at which a word agrees
OP3 = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM documents),
  i AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
  tw AS (SELECT doc_id, len(w) AS n, unnest(w) AS x, unnest(range(len(w))) AS at FROM t),
  iw AS (SELECT item_id, len(w) AS n, least(len(w), 13) AS span, unnest(w) AS x, unnest(range(len(w))) AS at FROM i WHERE len(w) >= 8),
  j AS (SELECT doc_id, item_id, span, tw.at - iw.at AS shift, tw.at AS at, least(tw.at, least(tw.n, iw.n + tw.at - iw.at) - span) AS first
        FROM tw JOIN iw USING (x)),
  k AS (SELECT *, count(*) OVER (PARTITION BY doc_id, item_id, shift) AS most FROM j WHERE first >= greatest(shift, 0)),
  c AS (SELECT a.doc_id, a.item_id, a.span, a.shift, a.at, a.first, count(*) AS same
        FROM k a JOIN k b ON a.doc_id = b.doc_id AND a.item_id = b.item_id AND a.shift = b.shift AND b.at BETWEEN a.first AND a.first + a.span - 1
        WHERE a.most >= a.span - 2 GROUP BY ALL)
SELECT doc_id, item_id, max(span) AS n_words, max(same) AS n_same FROM c GROUP BY ALL
HAVING max(same) >= max(span) - CASE WHEN max(span) = 13 THEN 2 ELSE 1 END
"""

#: every window of 400 bytes (800 hex digits) of every text
OP8 = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
  w AS (SELECT r, p, hash(substr(x, 2 * p + 1, 800)) AS h FROM (SELECT r, x, unnest(range(len(x) // 2 - 399)) AS p FROM t WHERE len(x) >= 800)),
  again AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
  hit AS (SELECT r, p FROM w SEMI JOIN again USING (h)),
  edge AS (SELECT r, p, CASE WHEN p - lag(p) OVER (PARTITION BY r ORDER BY p) <= 400 THEN 0 ELSE 1 END AS new FROM hit),
  run AS (SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p ROWS UNBOUNDED PRECEDING) AS k FROM edge),
  span AS (SELECT r, k, min(p) AS a, max(p) + 400 AS b FROM run GROUP BY r, k),
  gap AS (SELECT r, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS a, a AS b FROM span
          UNION ALL SELECT t.r, coalesce(max(s.b), 0), any_value(len(t.x)) // 2 FROM t LEFT JOIN span s USING (r) GROUP BY t.r),
  kept AS (SELECT gap.r, string_agg(substr(x, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS x FROM gap JOIN t USING (r) GROUP BY gap.r),
  gone AS (SELECT r, sum(b - a) AS n, count(*) AS spans FROM span GROUP BY r)
SELECT doc_id, len(t.x) // 2 AS n_bytes, coalesce(gone.n, 0)::BIGINT AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(kept.x)) AS kept_sha256
FROM t JOIN kept USING (r) LEFT JOIN gone USING (r)
"""

#: all distances
OP9 = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) v FROM embeddings),
     p AS (SELECT q.vec_id query_id, c.vec_id, list_distance(q.v, c.v) score
           FROM e q JOIN e c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY rank <= 10
"""

#: every contiguous run of one to four words of every piece
OP12 = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
  w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
  g AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
        FROM w, range(1, 5) t(m) WHERE len(w) >= m),
  f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL),
  n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
  c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 30),
  k AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS one, array_to_string(w[k + 1:], ' ') AS two FROM c, range(1, 4) t(k) WHERE k < m),
  s AS (SELECT k.lang, k.phrase, a, k, x.f AS l, y.f AS r, (2000000 * a::HUGEINT // (x.f + y.f))::BIGINT AS score
        FROM k JOIN f x ON x.lang = k.lang AND x.phrase = one JOIN f y ON y.lang = k.lang AND y.phrase = two),
  b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
  i AS (SELECT lang, phrase, max(a) AS most FROM (SELECT lang, a, unnest(list_transform(range(1, m - z + 2), lambda i: array_to_string(w[i:i + z - 1], ' '))) AS phrase
        FROM c, range(2, 4) t(z) WHERE z < m) GROUP BY ALL),
  o AS (SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank, b.phrase, a, l, r, score
        FROM b LEFT JOIN i USING (lang, phrase) WHERE most IS NULL OR 100 * most::HUGEINT < 80 * a::HUGEINT)
SELECT o.lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= 2000
"""

#: all inner products of anchors and rows
OP13 = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
        FROM e a JOIN e c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
  p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score QUALIFY rank <= 5
"""
