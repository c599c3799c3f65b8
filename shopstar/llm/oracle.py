"""DuckDB SQL for the corpus queries that SQL can express.

Toxicity, packing, quality classifier, quality rules and mixing have none: SQL
has neither their models, tokenizer and hashes nor their rounding. Tests compare
them with plain Python.
"""

from __future__ import annotations

LINE_DEDUP = """
WITH lines AS (
    SELECT doc_id, place, split[place] AS line,
           translate(trim(split[place], E' \\t\\n\\x0b\\x0c\\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS split FROM documents) AS d,
         unnest(range(1, len(split) + 1)) AS u(place)
), shared AS (
    SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT l.*, s.key IS NOT NULL AND s.keeper <> l.doc_id AS gone
    FROM lines AS l LEFT JOIN shared AS s ON s.key = l.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

WARC = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
), r AS (
    SELECT payload, max(page_id) AS response FROM p WHERE strlen(payload) >= 1000 GROUP BY payload
)
SELECT p.page_id, strlen(p.payload) AS payload_bytes, sha1(p.payload) AS payload_digest,
       CASE WHEN r.response <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN r.response <> p.page_id THEN r.response END AS refers_to
FROM p LEFT JOIN r USING (payload)
"""

EMBEDDINGS = """
WITH RECURSIVE valid AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM valid AS x JOIN valid AS y
    ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
    WHERE list_cosine_similarity(x.e, y.e) >= 0.93
), reached AS (
    SELECT vec_id, vec_id AS other FROM embeddings
    UNION SELECT r.vec_id, l.b FROM reached AS r JOIN links AS l ON l.a = r.other
), low AS (
    SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id
), n AS (
    SELECT a, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM low LEFT JOIN n ON n.a = vec_id
"""

JACCARD = """
WITH RECURSIVE worded AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
           ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])) END AS s
    FROM worded
), tokens AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets
), common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS n_a, any_value(y.n) AS n_b, count(*) AS met
    FROM tokens AS x JOIN tokens AS y ON x.t = y.t AND x.doc_id <> y.doc_id
     AND 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n)
    GROUP BY 1, 2
), links AS (
    SELECT a, b FROM common WHERE 100 * met >= 90 * (n_a + n_b - met)
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT r.doc_id, l.b FROM reached AS r JOIN links AS l ON l.a = r.other
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY 1) AS c USING (doc_id)
"""


EXACT = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256 FROM t JOIN g USING (text)
"""

DIVERGENCE = """
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), words AS (
    SELECT doc_id, lang, source,
           unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), per_doc AS (
    SELECT doc_id, lang, source, term, count(*) AS n FROM words GROUP BY ALL
), lang_terms AS (
    SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n FROM per_doc GROUP BY lang, term HAVING count(*) >= 10
), langs AS (
    SELECT lang, count(*) AS v, sum(n) AS total FROM lang_terms GROUP BY lang
), source_terms AS (
    SELECT p.lang, p.source, p.term, CAST(sum(p.n) AS HUGEINT) AS n
    FROM per_doc AS p JOIN lang_terms USING (lang, term) GROUP BY ALL
), groups AS (
    SELECT g.lang, g.source, coalesce(sum(s.n), 0) AS total
    FROM (SELECT DISTINCT lang, source FROM d) AS g LEFT JOIN source_terms AS s USING (lang, source) GROUP BY ALL
), shares AS (
    SELECT g.lang, g.source, t.term, coalesce(s.n, 0) AS n,
           1 + (1000000000 * (coalesce(s.n, 0) + 2)) // (g.total + 2 * l.v) AS p,
           1 + (1000000000 * (t.n + 2)) // (l.total + 2 * l.v) AS q
    FROM groups AS g JOIN langs AS l USING (lang) JOIN lang_terms AS t USING (lang)
    LEFT JOIN source_terms AS s ON s.lang = g.lang AND s.source = g.source AND s.term = t.term
), met AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares AS a JOIN shares AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(m.value, 0) AS value
    FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN met AS m ON m.lang = a.lang AND m.source = a.source AND m.item = b.source
), every AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM every QUALIFY part = 'pair' OR rank <= 10
"""


def centroid_sql(rounds: int = 5, clusters: int = 40) -> str:
    """Lloyd's rounds one after the other, every vector against every centroid."""
    ctes = [f"""
kept AS (
    SELECT vec_id, sha256('2:' || CAST(vec_id AS VARCHAR)) AS hash,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
    SELECT vec_id, unnest(e) AS x, unnest(range(64)) AS i FROM kept
), c0 AS (
    SELECT c, unnest(e) AS x, unnest(range(64)) AS i
    FROM (SELECT row_number() OVER (ORDER BY hash) - 1 AS c, e FROM kept QUALIFY c < {clusters})
)"""]
    for r in range(rounds + 1):
        ctes.append(f"""
a{r} AS (
    SELECT vec_id, arg_min(c, d * {clusters} + c) AS c, min(d) AS d FROM (
        SELECT vec_id, c, sum((p.x - k.x) * (p.x - k.x)) AS d FROM parts AS p JOIN c{r} AS k USING (i) GROUP BY vec_id, c)
    GROUP BY vec_id
)""")
        if r < rounds:
            ctes.append(f"""
m{r} AS (
    SELECT c, i, sum(x) AS s, count(*) AS n FROM parts JOIN a{r} USING (vec_id) GROUP BY c, i
), c{r + 1} AS (
    SELECT c, i, coalesce((s - ((s % n) + n) % n) // n, x) AS x FROM c{r} LEFT JOIN m{r} USING (c, i)
)""")
    return f"""
WITH {",".join(ctes)},
hashes AS (
    SELECT c, sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c
)
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM a{rounds} AS a JOIN hashes USING (c)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_ngram_jaccard_join": JACCARD,
        "op4_line_dedup": LINE_DEDUP,
        "op7_warc": WARC,
        "op9_embedding_near_dedup": EMBEDDINGS,
        "op11_centroid_clustering": centroid_sql(),
        "op12_source_divergence": DIVERGENCE,
        "op13_exact_dedup": EXACT,
    }
