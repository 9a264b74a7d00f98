"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op1_substring_dedup"] = r"""
WITH texts AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), placed AS MATERIALIZED (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts
), windows AS MATERIALIZED (
    SELECT doc_id, place,
           string_agg(word, ' ') OVER w AS run, count(*) OVER w AS n
    FROM placed
    WINDOW w AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
), ranked AS MATERIALIZED (
    SELECT doc_id, place, row_number() OVER (PARTITION BY run ORDER BY doc_id, place) > 1 AS again
    FROM windows WHERE n = 20
), covered AS (
    SELECT doc_id, p.place, word,
           coalesce(bool_or(again) OVER (
               PARTITION BY doc_id ORDER BY p.place ROWS BETWEEN 19 PRECEDING AND CURRENT ROW
           ), false) AS gone
    FROM placed p LEFT JOIN ranked USING (doc_id, place)
), kept AS (
    SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY place) AS kept
    FROM covered WHERE NOT gone GROUP BY doc_id
)
SELECT t.doc_id, len(t.words)::BIGINT AS n_words,
       (len(t.words) - coalesce(k.n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (doc_id)
"""

ORACLES["op3_decontaminate"] = r"""
WITH texts AS MATERIALIZED (
    SELECT doc_id,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'
           ) AS words
    FROM documents
), items AS MATERIALIZED (
    SELECT item_id,
           regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'
           ) AS words
    FROM benchmark
), windows AS MATERIALIZED (
    SELECT DISTINCT item_id, size, array_to_string(list_slice(words, spot, spot + size - 1), ' ') AS run
    FROM (
        SELECT item_id, words, least(13, len(words)) AS size,
               unnest(generate_series(1, len(words) - least(13, len(words)) + 1)) AS spot
        FROM items WHERE len(words) > 0
    )
), placed AS MATERIALIZED (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts
), runs AS MATERIALIZED (
    SELECT doc_id, place, string_agg(word, ' ') OVER w AS run
    FROM placed
    WINDOW w AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)
), found AS MATERIALIZED (
    SELECT doc_id, place, item_id, size FROM runs JOIN windows USING (run) WHERE size = 13
    UNION ALL
    SELECT doc_id, place, item_id, size FROM runs JOIN windows w
    ON w.size < 13 AND starts_with(runs.run || ' ', w.run || ' ')
), hits AS (
    SELECT doc_id, count(DISTINCT place + step) AS n_hit
    FROM (SELECT doc_id, place, unnest(generate_series(0, size - 1)) AS step FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM found) GROUP BY doc_id
)
SELECT t.doc_id, len(t.words)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
       coalesce(n.n_items, 0)::BIGINT AS n_items, sha256(coalesce(n.names, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(t.words) AS contaminated
FROM texts t LEFT JOIN hits h USING (doc_id) LEFT JOIN named n USING (doc_id)
"""

ORACLES["op8_warc"] = """
WITH payloads AS MATERIALIZED (
    SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex
    FROM pages
), firsts AS (
    SELECT hex, min(page_id) AS first FROM payloads GROUP BY hex
)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(generate_series(0, 31), lambda i: substr(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(hex, 5 * (i // 4)::INT + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1
       )), 'string_agg', '') AS payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM payloads JOIN firsts USING (hex)
"""

ORACLES["op11_jaccard_join"] = r"""
WITH RECURSIVE texts AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'
    ) AS words FROM documents
), shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(list_slice(words, spot, spot + 3), ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 3, 1))) AS spot FROM texts WHERE len(words) > 0)
), sizes AS MATERIALIZED (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS MATERIALIZED (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM shingles x JOIN shingles y USING (shingle) WHERE x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id
), links AS MATERIALIZED (
    SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * shared >= 85 * (p.n + q.n - shared)
), reached AS (
    SELECT doc_id AS origin, doc_id AS seen FROM sizes
    UNION
    SELECT r.origin, l.b FROM reached r JOIN links l ON l.a = r.seen
), least AS (
    SELECT origin, min(seen) AS component_id FROM reached GROUP BY origin
)
SELECT t.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(c.component_id, t.doc_id) AS component_id
FROM texts t LEFT JOIN sizes s USING (doc_id) LEFT JOIN least c ON c.origin = t.doc_id
"""

ORACLES["op12_ranked_search"] = r"""
WITH held AS MATERIALIZED (
    SELECT doc_id, term, count(*) AS tf FROM (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'
        )) AS term FROM documents
    ) GROUP BY doc_id, term
), asked AS MATERIALIZED (
    SELECT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'
    )) AS term FROM benchmark
), sizes AS MATERIALIZED (
    SELECT doc_id, sum(tf)::BIGINT AS n FROM held GROUP BY doc_id
), corpus AS (
    SELECT count(*)::BIGINT AS total, sum(n)::BIGINT AS words FROM sizes
), norms AS MATERIALIZED (
    SELECT doc_id, 100 - 25 + (25 * n * total) // words AS m FROM sizes, corpus
), weights AS MATERIALIZED (
    SELECT term, floor(1000 * ln((2 * total + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM held GROUP BY term), corpus
), scores AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN norms USING (doc_id)
    GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 20
"""

ORACLES["op13_hard_negatives"] = """
WITH given AS MATERIALIZED (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, a.label = c.label AS kin, c.vec_id AS other_id, list_dot_product(a.v, c.v)::BIGINT AS score
    FROM given a JOIN given c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE kin
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INT AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT kin AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score
QUALIFY rank <= 3
"""
