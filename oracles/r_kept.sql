-- needs: hub_candidates
WITH RECURSIVE ranked AS (
    SELECT *, row_number() OVER (PARTITION BY warehouse_id ORDER BY anomaly_score DESC, delay_delta_pp DESC, window_end) AS rn
    FROM hub_candidates
), walk AS (
    SELECT DISTINCT warehouse_id, CAST(0 AS BIGINT) AS rn, CAST([] AS DATE[]) AS kept FROM ranked
    UNION ALL
    SELECT w.warehouse_id, r.rn,
           CASE WHEN len(list_filter(w.kept, lambda e : r.window_end >= e - 13 AND r.window_start <= e)) = 0
                THEN list_append(w.kept, r.window_end) ELSE w.kept END
    FROM walk AS w JOIN ranked AS r ON r.warehouse_id = w.warehouse_id AND r.rn = w.rn + 1
), final AS (
    SELECT warehouse_id, unnest(max_by(kept, rn)) AS window_end FROM walk GROUP BY 1
)
SELECT printf('BIZ-CAND-%03d', row_number() OVER (ORDER BY c.anomaly_score DESC, c.delay_delta_pp DESC, c.warehouse_id,
                                                           c.window_end)) AS candidate_incident_id, c.*
FROM hub_candidates AS c JOIN final AS f ON c.warehouse_id = f.warehouse_id AND c.window_end = f.window_end
