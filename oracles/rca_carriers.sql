-- needs: r_scope r_period_long
WITH by_carrier AS (
    SELECT candidate_incident_id, period, carrier_id, carrier_name, count(*) AS n, avg(delayed_flag) * 100 AS delay
    FROM r_scope GROUP BY 1, 2, 3, 4
)
SELECT i.candidate_incident_id, i.carrier_id, i.carrier_name, i.n AS incident_shipments, i.delay AS incident_delay_pct,
       b.n AS baseline_shipments, coalesce(b.delay, o.delay_pct) AS baseline_delay_pct,
       i.delay - coalesce(b.delay, o.delay_pct) AS delay_delta_pp,
       CAST(i.n AS DOUBLE) / CAST(sum(i.n) OVER (PARTITION BY i.candidate_incident_id) AS DOUBLE) * 100
           AS incident_share_pct
FROM by_carrier AS i
LEFT JOIN by_carrier AS b ON i.candidate_incident_id = b.candidate_incident_id AND i.carrier_id = b.carrier_id
                         AND i.carrier_name = b.carrier_name AND b.period = 'baseline'
LEFT JOIN r_period_long AS o ON i.candidate_incident_id = o.candidate_incident_id AND o.period = 'baseline'
WHERE i.period = 'incident'
