-- needs: hub_incidents rca_verdict rca_support rca_period_metrics
SELECT i.candidate_incident_id, 'BUSINESS_INCIDENT' AS classification, i.city || ', ' || i.country AS location,
       i.warehouse_id, i.start_date AS window_start, i.end_date AS window_end, i.start_date - 60 AS baseline_start,
       i.start_date - 1 AS baseline_end, v.rca_status, v.primary_root_cause, v.confidence_score,
       coalesce(s.incident_cases, 0) AS incident_cases,
       'Warehouse/network load increased by ' || printf('%+.2f', load_delta_pp) || ' pp. | Delay rate changed by '
           || printf('%+.2f', delay_delta_pp) || ' pp. | ' || printf('%.1f', spread_pct_short)
           || '% of carriers present in the incident showed material delay deterioration. | '
           || 'Logistics Data Quality controls ' || CASE WHEN trusted = 1 THEN 'passed.' ELSE 'did not pass.' END AS evidence,
       v.trusted, m.baseline_delay_pct, m.incident_delay_pct, m.baseline_avg_load_pct, m.incident_avg_load_pct
FROM hub_incidents AS i
JOIN rca_verdict AS v ON i.candidate_incident_id = v.candidate_incident_id
JOIN rca_period_metrics AS m ON i.candidate_incident_id = m.candidate_incident_id
LEFT JOIN rca_support AS s ON i.candidate_incident_id = s.candidate_incident_id
