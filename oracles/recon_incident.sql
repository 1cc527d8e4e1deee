-- needs: daily_reconciliation
SELECT 'DQ-CAND-001' AS candidate_incident_id, 'DATA_INCIDENT_CANDIDATE' AS classification, 'app_events' AS domain,
       'APP_PURCHASE_RECONCILIATION' AS control, min(date) AS start_date, max(date) AS end_date,
       count(*) AS anomalous_days, CAST(sum(expected_purchase_count) AS BIGINT) AS expected_purchase_events,
       CAST(sum(observed_purchase_count) AS BIGINT) AS observed_purchase_events,
       CAST(sum(expected_purchase_count) - sum(observed_purchase_count) AS BIGINT) AS missing_purchase_events,
       round(sum(observed_purchase_count) / sum(expected_purchase_count) * 100, 2) AS observed_vs_expected_pct,
       CAST(sum(purchase_value_null_count) AS BIGINT) AS null_purchase_values,
       CAST(sum(CAST(expected_revenue_eur AS DECIMAL(18, 2))) AS DOUBLE) AS expected_revenue_eur,
       CAST(sum(CAST(observed_revenue_eur AS DECIMAL(18, 2))) AS DOUBLE) AS observed_event_revenue_eur,
       round(CAST(sum(CAST(observed_revenue_eur AS DECIMAL(18, 2))) AS DOUBLE)
             / CAST(sum(CAST(expected_revenue_eur AS DECIMAL(18, 2))) AS DOUBLE) * 100, 2) AS revenue_capture_pct,
       'Operational orders remain present while purchase telemetry is missing and/or incomplete.' AS evidence
FROM daily_reconciliation WHERE incident_flag = 1 HAVING count(*) > 0
