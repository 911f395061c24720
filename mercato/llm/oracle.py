"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

WORDS = r"[^\x20\x09-\x0D]+"
STRIP = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

MIX = rf"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORDS}')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([1, 2, 3])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s),
r AS (SELECT *, (source_size * 3) / weight AS ratio FROM w),
l AS (SELECT *, ((sum(source_size) OVER ())::BIGINT - coalesce(sum(source_size * 3) OVER (ORDER BY ratio, source NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
        / (sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level FROM r),
f AS (SELECT *, max(CASE WHEN level <= ratio THEN level END) OVER () AS found FROM l),
t AS (SELECT source, source_size, CASE WHEN ratio < found THEN (source_size * 3)::DOUBLE ELSE found * weight END AS target FROM f),
p AS (SELECT doc_id, d.source, size, source_size, target,
             CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS expected,
             ('0x' || substr(md5('mix:7:' || coalesce('s' || d.source, 'null')), 1, 5))::BIGINT / 1048576.0 AS shift,
             row_number() OVER (PARTITION BY d.source ORDER BY length(bin(size)),
                 ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT % greatest(1, ((SELECT count(*) FROM documents) + 49999) // 50000),
                 size, doc_id NULLS FIRST) AS nth
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       size * (floor(nth * expected + shift) - floor((nth - 1) * expected + shift))::BIGINT AS taken FROM p"""

EXACT = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)"""

LINES = f"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM s),
k AS (SELECT *, translate(trim(line, {STRIP}), {LOWER}) AS key FROM l),
m AS (SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
x AS (SELECT k.*, m.key IS NOT NULL AND k.doc_id <> m.keeper AS dropped FROM k LEFT JOIN m ON k.key = m.key)
SELECT doc_id, count(*) AS n_lines, sum(dropped::INT)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN NOT dropped THEN line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM x GROUP BY doc_id"""

JACCARD = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '{WORDS}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
          ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM c JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * common >= 75 * (nx.n + ny.n - common)),
u AS (SELECT x AS a, y AS b FROM e UNION SELECT y, x FROM e),
r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, u.b FROM r JOIN u ON r.seen = u.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.seen) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.node = d.doc_id GROUP BY d.doc_id"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (1 + ((('0x' || substr(x, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31))::BIGINT, 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM q"""

VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS node, vec_id AS seen FROM embeddings UNION SELECT r.node, u.b FROM r JOIN u ON r.seen = u.a),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT e.vec_id, (SELECT count(*) FROM u WHERE u.a = e.vec_id) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN c ON c.node = e.vec_id"""

NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
u AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, x) = 1),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
      FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""

ORACLE_SQL = {"op13_hard_negatives": NEGATIVES, "op2_embedding_neardup": VECTORS, "op1_mix_sources": MIX, "op5_exact_dedup": EXACT, "op6_ngram_jaccard": JACCARD, "op9_line_dedup": LINES, "op10_warc": WARC}
