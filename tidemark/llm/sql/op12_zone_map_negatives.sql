WITH v AS (
    SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
    SELECT a.row AS anchor, a.vec_id AS anchor_id, a.label = b.label AS same, b.row, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
    FROM v AS a JOIN v AS b ON a.row <> b.row
    WHERE a.vec_id % 100 = 0
),
near AS (
    SELECT anchor, anchor_id, row AS positive, vec_id AS positive_id, score AS positive_score
    FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row) <= 5
),
fit AS (
    SELECT near.*, pairs.vec_id AS negative_id, pairs.score AS negative_score,
        row_number() OVER (PARTITION BY near.anchor, positive ORDER BY pairs.score DESC, pairs.vec_id, pairs.row) AS rank
    FROM near JOIN pairs ON near.anchor = pairs.anchor AND NOT pairs.same
        AND 30 * positive_score <= 100 * pairs.score AND 100 * pairs.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM fit WHERE rank <= 10
