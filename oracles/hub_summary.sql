-- needs: hub_windows hub_incidents dq_domain_trust
SELECT (SELECT count(*) FROM hub_windows) AS windows_evaluated,
       (SELECT count(*) FROM hub_incidents) AS business_incident_candidates, checks AS logistics_controls_checked,
       failures AS logistics_failures, trusted AS logistics_data_passed
FROM dq_domain_trust
