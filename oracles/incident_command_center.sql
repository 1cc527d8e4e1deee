-- needs: incident_registry decision_briefs
SELECT r.incident_id, r.classification, severity, domain, location, detected_start_date AS incident_start_date,
       detected_end_date AS incident_end_date, duration_days, round(confidence_score, 2) AS confidence_score, primary_cause,
       data_trust_status, business_metric, business_impact, affected_records, missing_records, r.anomaly_score,
       r.event_coverage_pct, revenue_capture_pct, null_value_pct, decision_status, decision_label, executive_summary,
       d.recommended_actions, d.evidence,
       CASE r.classification WHEN 'DATA_INCIDENT' THEN 'Data Reliability' WHEN 'BUSINESS_INCIDENT' THEN 'Operations'
            ELSE 'Other' END AS incident_family,
       CASE severity WHEN 'Critical' THEN 4 WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 ELSE 1 END AS severity_rank,
       CASE WHEN data_trust_status = 'FAILED' THEN 'Do Not Trust KPI'
            WHEN r.classification = 'BUSINESS_INCIDENT' THEN 'Business Action Required' ELSE 'Monitor' END AS command_center_status,
       CASE WHEN r.classification = 'DATA_INCIDENT' AND data_trust_status = 'FAILED' THEN 'Investigate Data Pipeline'
            WHEN r.classification = 'BUSINESS_INCIDENT' AND data_trust_status = 'PASSED' THEN 'Investigate Business Operations'
            ELSE 'Manual Review' END AS investigation_path
FROM incident_registry AS r LEFT JOIN decision_briefs AS d ON r.incident_id = d.incident_id
