"""DuckDB twins of the queries that SQL can express."""

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n FROM d GROUP BY source
), w AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r, source_size * 2 AS cap FROM s
), ww AS (
  SELECT *, CASE r % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM w
), o AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, r) AS place FROM ww
), l AS (
  SELECT *,
    (1.5::DOUBLE * (SELECT sum(source_size)::BIGINT FROM s)
      - coalesce(sum(cap) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
    / ((SELECT sum(weight) FROM ww)
      - coalesce(sum(weight) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      )::BIGINT AS lev
  FROM o
), t AS (
  SELECT source, source_size, n,
    least(cap::DOUBLE, coalesce((SELECT lev FROM l x WHERE x.lev * x.weight <= x.cap ORDER BY x.place LIMIT 1)
      * weight, cap::DOUBLE)) AS target
  FROM l
), b AS (
  SELECT d.*, t.source_size, t.target,
    floor((('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE)
      * ceil(t.n / 4096.0::DOUBLE))::BIGINT AS bucket,
    ('0x' || substr(md5('mix-1:' || coalesce(d.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), k AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY bucket, size, doc_id NULLS FIRST) AS place,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS e
  FROM b
)
SELECT doc_id, size, source_size, target,
  ((floor(u + e * place) - floor(u + e * (place - 1)))::BIGINT * size)::BIGINT AS taken
FROM k
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98
), r AS (
  SELECT vec_id AS id, vec_id AS reached FROM embeddings
  UNION
  SELECT r.id, p.b FROM r JOIN p ON r.reached = p.a
), c AS (SELECT id, min(reached) AS component_id FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.id = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The short notices as patterns over words joined by spaces; the long texts do not occur in the tables' words, and
# are matched by their first and last words with everything between.
LICENSES = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), j AS (
  SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS t FROM d
), p AS (
  SELECT doc_id, w, t,
    list_filter(range(0, len(w)), lambda i: (w[i + 1] = 'mit' AND w[i + 2] = 'license')
      OR (w[i + 1] = 'apache' AND w[i + 2] = 'license')
      OR (w[i + 1] = 'general' AND w[i + 2] = 'public' AND w[i + 3] = 'license')) AS places,
    list_filter([
      CASE WHEN contains(t, ' apache license ') THEN 'apache' END,
      CASE WHEN contains(t, ' general public license ') THEN 'gpl' END,
      CASE WHEN contains(t, ' mit license ') THEN 'mit' END], lambda x: x IS NOT NULL) AS base,
    list_filter([
      CASE WHEN regexp_matches(t, ' licensed under the apache license (version )?2 0 ')
        THEN 'apache-2.0-notice' END,
      CASE WHEN regexp_matches(t, ' licensed under the apache license version 2 0 the license you may not use this .* either express or implied ')
        THEN 'apache-2.0-header' END,
      CASE WHEN regexp_matches(t, ' redistribution and use in source and binary forms .* contributors may be used ')
        THEN 'bsd-3-clause-text' END,
      CASE WHEN regexp_matches(t, ' licensed under (the )?(creative commons )?cc by nc 4 0 ')
        THEN 'cc-by-nc-4.0-notice' END,
      CASE WHEN regexp_matches(t, ' licensed under the (terms of the )?gnu general public license (version )?3 ')
        THEN 'gpl-3.0-notice' END,
      CASE WHEN regexp_matches(t, '[^ ] under the (terms of the )?mit license ') THEN 'mit-notice' END,
      CASE WHEN regexp_matches(t, ' permission is hereby granted free of charge .* substantial portions of the software ')
        THEN 'mit-text' END], lambda x: x IS NOT NULL) AS more
  FROM j
)
SELECT doc_id, len(w)::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(places) AS first_word,
  list_max(places) AS last_word, array_to_string(base, ',') AS base_labels,
  array_to_string(list_sort(list_concat(base, more)), ',') AS labels,
  CASE WHEN len(more) > 0 THEN 1.0 WHEN len(base) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM p
"""


COLLOCATIONS = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
p AS (SELECT lang, row_number() OVER () AS pid, piece
      FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
pw AS (SELECT lang, pid, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
w AS (SELECT lang, pid, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM pw WHERE len(ws) > 0),
g AS (SELECT lang, word AS w1, lead(word, 1) OVER win AS w2, lead(word, 2) OVER win AS w3,
             lead(word, 3) OVER win AS w4, lead(word, 4) OVER win AS w5
      FROM w WINDOW win AS (PARTITION BY pid ORDER BY i)),
grams AS (
  SELECT lang, w1 AS phrase FROM g
  UNION ALL SELECT lang, w1 || ' ' || w2 FROM g WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 FROM g WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM g WHERE w4 IS NOT NULL
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 FROM g WHERE w5 IS NOT NULL),
tot AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
f AS (SELECT lang, phrase, count(*) AS f FROM grams GROUP BY lang, phrase HAVING count(*) >= 100),
c AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS ws, len(string_split(phrase, ' ')) AS k
      FROM f WHERE len(string_split(phrase, ' ')) >= 2),
cuts AS (SELECT c.lang, c.phrase, c.a, j, array_to_string(c.ws[1:j], ' ') AS lp,
                array_to_string(c.ws[j + 1:c.k], ' ') AS rp
         FROM c, range(1, 5) AS jj(j) WHERE j < c.k),
scored AS (SELECT cuts.lang, cuts.phrase, cuts.a, cuts.j, fl.f AS l, fr.f AS r, tot.n,
                  (cuts.a::HUGEINT * tot.n * 1000) // (fl.f::HUGEINT * fr.f) AS score
           FROM cuts JOIN f fl ON fl.lang = cuts.lang AND fl.phrase = cuts.lp
                     JOIN f fr ON fr.lang = cuts.lang AND fr.phrase = cuts.rp
                     JOIN tot ON tot.lang = cuts.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
subs AS (SELECT c.lang, array_to_string(c.ws[s:s + m - 1], ' ') AS sub, c.a AS fl
         FROM c, range(1, 5) AS ss(s), range(2, 5) AS mm(m) WHERE m < c.k AND s + m - 1 <= c.k),
cover AS (SELECT lang, sub, max(fl) AS fl FROM subs GROUP BY lang, sub),
kept AS (SELECT b.* FROM best b LEFT JOIN cover v ON v.lang = b.lang AND v.sub = b.phrase
         WHERE v.fl IS NULL OR v.fl < b.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
         phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
  FROM kept)
WHERE rank <= 2000
"""
