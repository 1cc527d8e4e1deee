-- needs: incident_registry
SELECT incident_id, CAST((classification NOT IN ('DATA_INCIDENT', 'BUSINESS_INCIDENT')) AS INTEGER)
       + CAST((data_trust_status NOT IN ('PASSED', 'FAILED')) AS INTEGER)
       + CAST((confidence_score NOT BETWEEN 0 AND 100) AS INTEGER) AS violations
FROM incident_registry
