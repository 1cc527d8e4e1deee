-- needs: incident_registry
SELECT count(*) AS total_incidents, count(*) FILTER (classification = 'DATA_INCIDENT') AS data_incidents,
       count(*) FILTER (classification = 'BUSINESS_INCIDENT') AS business_incidents,
       count(*) FILTER (data_trust_status = 'FAILED') AS failed_trust_incidents,
       count(*) FILTER (severity = 'Critical') AS critical_incidents, max(confidence_score) AS max_incident_confidence,
       max(anomaly_score) AS max_anomaly_score
FROM incident_registry
