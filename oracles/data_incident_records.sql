-- needs: recon_incident dq_trust_summary
WITH rated AS (
    SELECT *, null_purchase_values / greatest(CAST(observed_purchase_events AS DOUBLE), 1) * 100 AS null_rate
    FROM recon_incident, dq_trust_summary
)
SELECT 'DATA_INCIDENT' AS classification,
       CASE WHEN revenue_capture_pct < 40 OR observed_vs_expected_pct < 60 THEN 'Critical'
            WHEN revenue_capture_pct < 70 OR observed_vs_expected_pct < 80 THEN 'High' ELSE 'Medium' END AS severity,
       domain, CAST(NULL AS VARCHAR) AS location, start_date AS detected_start_date, end_date AS detected_end_date,
       round(least(greatest(
           least(greatest((100 - observed_vs_expected_pct) / 40 * 100, 0), 100) * CAST(0.35 AS DOUBLE)
           + least(greatest((100 - revenue_capture_pct) / 60 * 100, 0), 100) * CAST(0.35 AS DOUBLE)
           + least(greatest(null_rate / 30 * 100, 0), 100) * CAST(0.20 AS DOUBLE)
           + (CASE WHEN non_app_failures = 0 THEN 100 ELSE 40 END) * CAST(0.10 AS DOUBLE), 0), 99), 2) AS confidence_score,
       'Purchase Telemetry Failure' AS primary_cause, expected_purchase_events AS affected_records,
       missing_purchase_events AS missing_records, 'FAILED' AS data_trust_status, CAST(NULL AS DOUBLE) AS anomaly_score,
       observed_vs_expected_pct AS event_coverage_pct, revenue_capture_pct, round(null_rate, 2) AS null_value_pct,
       'Purchase Events / Event Revenue' AS business_metric,
       missing_purchase_events || ' purchase events missing; event revenue captured at '
           || printf('%.2f', revenue_capture_pct) || '% of trusted operational revenue.' AS business_impact,
       'Do not use affected purchase-event revenue for decision-making. '
           || 'Investigate telemetry pipeline, schema changes and purchase event emission.' AS recommended_action,
       evidence
FROM rated
