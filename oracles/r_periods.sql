-- needs: hub_incidents
SELECT candidate_incident_id, warehouse_id, 'incident' AS period, start_date AS s, end_date AS e FROM hub_incidents
UNION ALL
SELECT candidate_incident_id, warehouse_id, 'baseline', start_date - 60, start_date - 1 FROM hub_incidents
