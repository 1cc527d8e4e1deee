-- needs: data_reliability_daily
SELECT min(report_date) AS incident_start, max(report_date) AS incident_end,
       CAST(sum(expected_purchase_count) AS BIGINT) AS expected_purchases,
       CAST(sum(observed_purchase_count) AS BIGINT) AS observed_purchases,
       CAST(sum(missing_purchase_events) AS BIGINT) AS missing_purchases,
       CAST(sum(purchase_value_null_count) AS BIGINT) AS null_values,
       round(100 * sum(observed_purchase_count) / sum(expected_purchase_count), 2) AS event_coverage_pct,
       round(100 * CAST(sum(CAST(observed_event_revenue_eur AS DECIMAL(18, 2))) AS DOUBLE)
             / CAST(sum(CAST(expected_revenue_eur AS DECIMAL(18, 2))) AS DOUBLE), 2) AS revenue_capture_pct
FROM data_reliability_daily WHERE data_incident_flag = 1
