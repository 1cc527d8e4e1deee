-- needs: hub_incidents r_reports
SELECT 'BUSINESS_INCIDENT' AS classification,
       CASE WHEN coalesce(r.confidence_score, i.anomaly_score) >= 90 AND i.shipments >= 100 THEN 'Critical'
            WHEN coalesce(r.confidence_score, i.anomaly_score) >= 75 THEN 'High' ELSE 'Medium' END AS severity,
       'logistics' AS domain, i.city || ', ' || i.country AS location, i.start_date AS detected_start_date,
       i.end_date AS detected_end_date, round(coalesce(r.confidence_score, i.anomaly_score), 2) AS confidence_score,
       coalesce(r.primary_root_cause, 'Operational Performance Degradation') AS primary_cause,
       i.shipments AS affected_records, CAST(0 AS BIGINT) AS missing_records,
       CASE WHEN coalesce(r.trusted, 1) = 1 THEN 'PASSED' ELSE 'FAILED' END AS data_trust_status, i.anomaly_score,
       CAST(NULL AS DOUBLE) AS event_coverage_pct, CAST(NULL AS DOUBLE) AS revenue_capture_pct,
       CAST(NULL AS DOUBLE) AS null_value_pct, 'Delivery SLA / Delay Rate' AS business_metric,
       i.shipments || ' shipments evaluated; delay rate ' || coalesce(printf('%.2f', round(r.baseline_delay_pct, 2)), 'n/a')
           || '% -> ' || coalesce(printf('%.2f', round(r.incident_delay_pct, 2)), 'n/a') || '%; network load '
           || coalesce(printf('%.2f', round(r.baseline_avg_load_pct, 2)), 'n/a') || '% -> '
           || coalesce(printf('%.2f', round(r.incident_avg_load_pct, 2)), 'n/a') || '%; '
           || coalesce(r.incident_cases, i.affected_support_cases, 0) || ' support cases affected.' AS business_impact,
       'Investigate warehouse capacity, network load and operational throughput. '
           || 'Prioritize load balancing and temporary capacity mitigation.' AS recommended_action,
       coalesce(r.evidence, i.evidence) AS evidence
FROM hub_incidents AS i LEFT JOIN r_reports AS r ON i.candidate_incident_id = r.candidate_incident_id
