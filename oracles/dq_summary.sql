-- needs: r_weights recon_incident
SELECT round(sum(CASE WHEN status = 'PASS' THEN weight ELSE 0 END) / sum(weight) * 100, 2) AS data_health_score,
       count(*) AS controls_executed, count(*) FILTER (status = 'PASS') AS controls_passed,
       count(*) FILTER (status = 'FAIL') AS controls_failed,
       (SELECT count(*) FROM recon_incident) AS data_incident_candidates
FROM r_weights
