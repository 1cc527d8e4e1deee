-- needs: r_periods bronze_shipments hub_incidents
WITH rates AS (
    SELECT p.candidate_incident_id, p.period, avg(s.delayed_flag) AS rate
    FROM r_periods AS p JOIN bronze_shipments AS s ON s.shipment_date BETWEEN p.s AND p.e GROUP BY 1, 2
)
SELECT i.candidate_incident_id, coalesce((n.rate - b.rate) * 100, 0) AS network_delta
FROM hub_incidents AS i
LEFT JOIN rates AS n ON i.candidate_incident_id = n.candidate_incident_id AND n.period = 'incident'
LEFT JOIN rates AS b ON i.candidate_incident_id = b.candidate_incident_id AND b.period = 'baseline'
