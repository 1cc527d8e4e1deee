-- needs: data_reliability_daily
SELECT CAST(sum(expected_purchase_count) AS BIGINT) AS expected_purchases,
       CAST(sum(observed_purchase_count) AS BIGINT) AS observed_purchases,
       CAST(sum(missing_purchase_events) AS BIGINT) AS missing_purchase_events,
       sum(observed_purchase_count) / sum(expected_purchase_count) AS event_coverage,
       CAST(sum(CAST(expected_revenue_eur AS DECIMAL(18, 2))) AS DOUBLE) AS expected_revenue,
       CAST(sum(CAST(observed_event_revenue_eur AS DECIMAL(18, 2))) AS DOUBLE) AS observed_event_revenue,
       CAST(sum(CAST(observed_event_revenue_eur AS DECIMAL(18, 2))) AS DOUBLE)
           / CAST(sum(CAST(expected_revenue_eur AS DECIMAL(18, 2))) AS DOUBLE) AS revenue_capture,
       count(*) FILTER (data_trust_status = 'FAILED') AS data_trust_failed_days
FROM data_reliability_daily
