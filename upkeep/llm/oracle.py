"""DuckDB SQL for the queries of this subpackage that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op11_fill_middle"] = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256(concat('1:', doc_id)) AS h FROM documents
), drawn AS (
  SELECT doc_id, t, n, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b,
         ('0x' || h[17:24])::BIGINT % 100 AS c, ('0x' || h[25:32])::BIGINT % 100 AS d
  FROM texts
), chosen AS (
  SELECT doc_id, t, n, least(a, b) AS p, greatest(a, b) AS m,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain' WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN m - p END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
              WHEN 'psm' THEN '<P>' || substr(t, 1, p) || '<S>' || substr(t, m + 1) || '<M>' || substr(t, p + 1, m - p)
              ELSE '<S>' || substr(t, m + 1) || '<P>' || substr(t, 1, p) || '<M>' || substr(t, p + 1, m - p) END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM chosen
"""

ORACLE["op13_hard_negatives"] = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank,
         s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
       AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""
