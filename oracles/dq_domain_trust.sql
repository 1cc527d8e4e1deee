-- needs: dq_controls
SELECT count(*) AS checks, count(*) FILTER (status = 'FAIL') AS failures,
       CASE WHEN count(*) FILTER (status = 'FAIL') = 0 THEN 1 ELSE 0 END AS trusted
FROM dq_controls WHERE domain IN ('shipments', 'tracking_events', 'logistics')
