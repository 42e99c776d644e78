"""DuckDB SQL for the queries whose exact result SQL can tell, written from their definitions.

The others depend on trained models, compression, tokenizers or free numbering.
"""

from __future__ import annotations

#: words of a text, as the operators split them
WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"
#: only A-Z change, unlike lower()
LOWER_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

BYTES = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
starts AS (SELECT doc_id, n, h, unnest(range(n - 49)) AS i FROM d WHERE n >= 50),
w AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 100)) AS k FROM starts),
first AS (SELECT k, min(doc_id) AS least FROM w GROUP BY k HAVING count(DISTINCT doc_id) > 1),
hit AS (SELECT w.doc_id, w.i FROM w JOIN first USING (k) WHERE first.least < w.doc_id),
run AS (SELECT doc_id, i, i > max(i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 50 AS gap FROM hit),
span AS (SELECT doc_id, i, sum(CASE WHEN gap THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM run),
cut AS (SELECT doc_id, g, min(i) AS a, max(i) + 50 AS b FROM span GROUP BY doc_id, g),
kept AS (SELECT c.doc_id, c.a, c.b, coalesce(lag(c.b) OVER (PARTITION BY c.doc_id ORDER BY c.a), 0) AS before, d.h
         FROM cut c JOIN d USING (doc_id)),
rest AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
                string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM kept GROUP BY doc_id)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(r.n_removed, 0)::BIGINT AS n_removed, coalesce(r.n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(r.kept || substr(d.h, 2 * r.last + 1), d.h))) AS kept_sha256
FROM d LEFT JOIN rest r USING (doc_id)
"""

JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(text=LOWER_AZ)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 75 * (p.n + q.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id FROM least LEFT JOIN n USING (doc_id)
"""

VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
many AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM least LEFT JOIN many USING (vec_id)
"""

PASSAGES = f"""
WITH d AS (SELECT doc_id, {WORDS.format(text="text")} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
g AS (SELECT doc_id, i, md5_number(array_to_string(w[i:i + 49], ' ')) AS k FROM starts),
first AS (SELECT k, min(doc_id) AS least FROM g GROUP BY k HAVING count(DISTINCT doc_id) > 1),
hit AS (SELECT DISTINCT g.doc_id, unnest(range(g.i, g.i + 50)) AS i FROM g JOIN first USING (k) WHERE first.least < g.doc_id),
gone AS (SELECT doc_id, list(i) AS gone FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""

PHRASES = f"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER_AZ}, '[.,;:!?\x0A-\x0D]')) AS t FROM documents),
w AS (SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM piece),
g AS (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) ks(k) WHERE len(w) >= k),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL),
total AS (SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
candidate AS (SELECT * FROM f WHERE k >= 2 AND f >= 100),
alone AS (SELECT * FROM candidate c WHERE NOT EXISTS (SELECT 1 FROM candidate x WHERE x.lang = c.lang AND x.k > c.k AND 100 * x.f >= 100 * c.f
            AND contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' '))),
cut AS (SELECT lang, phrase, k, f, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS j FROM alone),
scored AS (SELECT cut.lang, cut.phrase, cut.j, cut.f AS a, x.f AS l, y.f AS r, n, (1000::HUGEINT * cut.f * n) // (x.f::HUGEINT * y.f) AS score
  FROM cut JOIN total USING (lang)
  JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(cut.w[:cut.j], ' ')
  JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(cut.w[cut.j + 1:], ' ')),
least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
top AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM least)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM top WHERE rank <= 2000
"""

ORACLES = {"op2_suffix_dedup": BYTES, "op3_jaccard_join": JACCARD, "op5_near_vectors": VECTORS, "op7_substring_dedup": PASSAGES, "op12_collocations": PHRASES}
