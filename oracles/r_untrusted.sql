-- needs: dq_controls
SELECT count(*) AS checks, CAST(1 AS BIGINT) AS failures, 0 AS trusted
FROM dq_controls WHERE domain IN ('shipments', 'tracking_events', 'logistics')
