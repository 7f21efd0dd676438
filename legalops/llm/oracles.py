"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

SPACE = r"[\x20\x09-\x0D]+"

EXACT = rf"""
WITH d AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM d WINDOW same AS (PARTITION BY text_sha256)
"""

CHAT = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(replace(replace(role || text, '<', '<\'), '[', '[\'))
           + length('<|im_start|>') + 1 + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

VECTORS = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL)) = 0
      AND len(list_filter(embedding, lambda e: NOT isfinite(e))) = 0
      AND len(list_filter(embedding, lambda e: e <> 0)) > 0
),
link AS MATERIALIZED (
    SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
    WHERE list_cosine_similarity(a.x, b.x) >= 0.98
),
reach AS (
    SELECT u AS node, v AS seen FROM link
    UNION SELECT r.node, l.v FROM reach r JOIN link l ON l.u = r.seen
),
n AS (SELECT u, count(*) AS n FROM link GROUP BY u),
c AS (SELECT node, min(seen) AS least FROM reach GROUP BY node)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(least(c.least, e.vec_id), e.vec_id) AS component_id,
       coalesce(least(c.least, e.vec_id), e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.u = e.vec_id LEFT JOIN c ON c.node = e.vec_id
"""

MINHASH = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SPACE}'), lambda x: x <> '') AS ws
    FROM documents
),
s AS MATERIALIZED (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS sh
    FROM w
),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
same AS MATERIALIZED (
    SELECT min(doc_id) AS rep, list(doc_id) AS docs FROM (SELECT doc_id, list(sh ORDER BY sh) AS shs FROM s GROUP BY doc_id) GROUP BY shs
),
rs AS MATERIALIZED (SELECT s.doc_id, s.sh FROM s JOIN same ON same.rep = s.doc_id),
shared AS MATERIALIZED (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM rs a JOIN rs b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL
),
link AS MATERIALIZED (
    SELECT u, v FROM shared JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 80 * (x.n + y.n - k)
),
reach AS (SELECT u AS node, v AS seen FROM link UNION SELECT r.node, l.v FROM reach r JOIN link l ON l.u = r.seen),
c AS (SELECT node, min(seen) AS least FROM reach GROUP BY node),
m AS (SELECT unnest(docs) AS doc_id, rep FROM same)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(c.least, m.rep), d.doc_id) AS component_id,
       coalesce(least(c.least, m.rep), d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id) LEFT JOIN c ON c.node = m.rep
"""


# Half the texts stay plain, and so do those that hold a marker.
FILL_MIDDLE = r"""
WITH h AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens
    FROM documents
),
d AS (
    SELECT *, len(tokens) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(tokens) + 1) AS c1,
           CAST('0x' || h[9:16] AS BIGINT) % (len(tokens) + 1) AS c2,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                  OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
                WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM h
),
cut AS (
    SELECT *, array_to_string(tokens[:least(c1, c2)], '') AS prefix,
           array_to_string(tokens[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
           array_to_string(tokens[greatest(c1, c2) + 1:], '') AS suffix
    FROM d
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
              ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""

HARD_NEGATIVES = """
WITH v AS MATERIALIZED (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
       n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_exact_dedup": EXACT,
        "op7_chat": CHAT,
        "op8_embedding_dedup": VECTORS,
        "op9_minhash": MINHASH,
        "op11_fill_middle": FILL_MIDDLE,
        "op13_hard_negatives": HARD_NEGATIVES,
    }
