-- needs: r_orders orders_enriched bronze_shipments bronze_cases r_events executive_daily logistics_performance data_reliability_daily recon_incident daily_reconciliation incident_shipment_pairs commerce_performance incident_command_center incident_registry hub_incidents r_bounds
WITH checks(contract, check_name, expected, observed) AS (
    SELECT 'silver', 'orders', (SELECT count(*) FROM r_orders), count(*) FROM orders_enriched
    UNION ALL SELECT 'silver', 'shipments', (SELECT count(*) FROM bronze_shipments), count(*) FROM bronze_shipments
    UNION ALL SELECT 'silver', 'cases', (SELECT count(*) FROM bronze_cases), count(*) FROM bronze_cases
    UNION ALL SELECT 'silver', 'purchases', (SELECT count(*) FROM r_events WHERE event_type = 'purchase'), sum(purchase_events)
        FROM executive_daily
    UNION ALL SELECT 'silver', 'order_duplicates', 0, count(*) - count(DISTINCT order_id) FROM orders_enriched
    UNION ALL SELECT 'silver', 'shipment_duplicates', 0, count(*) - count(DISTINCT shipment_id) FROM bronze_shipments
    UNION ALL SELECT 'silver', 'case_duplicates', 0, count(*) - count(DISTINCT case_id) FROM bronze_cases
    UNION ALL SELECT 'silver', 'payment_mismatches', 0, count(*) FROM orders_enriched
        WHERE abs(payment_reconciliation_delta_eur) > 0.01
    UNION ALL SELECT 'executive_daily', 'rows', (SELECT end_date - start_date + 1 FROM r_bounds), count(*) FROM executive_daily
    UNION ALL SELECT 'executive_daily', 'unique_dates', (SELECT end_date - start_date + 1 FROM r_bounds),
        count(DISTINCT report_date) FROM executive_daily
    UNION ALL SELECT 'executive_daily', 'min_date', (SELECT start_date - DATE '1970-01-01' FROM r_bounds),
        min(report_date) - DATE '1970-01-01' FROM executive_daily
    UNION ALL SELECT 'executive_daily', 'max_date', (SELECT end_date - DATE '1970-01-01' FROM r_bounds),
        max(report_date) - DATE '1970-01-01' FROM executive_daily
    UNION ALL SELECT 'executive_daily', 'orders', (SELECT count(*) FROM r_orders), sum(orders) FROM executive_daily
    UNION ALL SELECT 'executive_daily', 'shipments', (SELECT count(*) FROM bronze_shipments), sum(shipments) FROM executive_daily
    UNION ALL SELECT 'executive_daily', 'support_cases', (SELECT count(*) FROM bronze_cases), sum(support_cases) FROM executive_daily
    UNION ALL SELECT 'executive_daily', 'purchase_events', (SELECT count(*) FROM r_events WHERE event_type = 'purchase'),
        sum(purchase_events) FROM executive_daily
    UNION ALL SELECT 'logistics_performance', 'shipment_touches', (SELECT 2 * count(*) FROM bronze_shipments), sum(shipment_touches)
        FROM logistics_performance
    UNION ALL SELECT 'logistics_performance', 'min_date', (SELECT min(shipment_date) - DATE '1970-01-01' FROM bronze_shipments),
        min(report_date) - DATE '1970-01-01' FROM logistics_performance
    UNION ALL SELECT 'logistics_performance', 'max_date', (SELECT max(shipment_date) - DATE '1970-01-01' FROM bronze_shipments),
        max(report_date) - DATE '1970-01-01' FROM logistics_performance
    UNION ALL SELECT 'logistics_performance', 'incident_visible', (SELECT CAST(count(*) > 0 AS INTEGER) FROM hub_incidents),
        CAST(sum(business_incident_flag) > 0 AS INTEGER) FROM logistics_performance
    UNION ALL SELECT 'data_reliability', 'rows', (SELECT count(*) FROM daily_reconciliation), count(*) FROM data_reliability_daily
    UNION ALL SELECT 'data_reliability', 'unique_dates', (SELECT count(*) FROM daily_reconciliation),
        count(DISTINCT report_date) FROM data_reliability_daily
    UNION ALL SELECT 'data_reliability', 'incident_days', (SELECT coalesce(sum(anomalous_days), 0) FROM recon_incident),
        sum(data_incident_flag) FROM data_reliability_daily
    UNION ALL SELECT 'data_reliability', 'expected_purchases', (SELECT coalesce(sum(expected_purchase_events), 0) FROM recon_incident),
        sum(data_incident_flag * expected_purchase_count) FROM data_reliability_daily
    UNION ALL SELECT 'data_reliability', 'observed_purchases', (SELECT coalesce(sum(observed_purchase_events), 0) FROM recon_incident),
        sum(data_incident_flag * observed_purchase_count) FROM data_reliability_daily
    UNION ALL SELECT 'data_reliability', 'missing_purchases', (SELECT coalesce(sum(missing_purchase_events), 0) FROM recon_incident),
        sum(data_incident_flag * missing_purchase_events) FROM data_reliability_daily
    UNION ALL SELECT 'data_reliability', 'null_values', (SELECT coalesce(sum(null_purchase_values), 0) FROM recon_incident),
        sum(data_incident_flag * purchase_value_null_count) FROM data_reliability_daily
    UNION ALL SELECT 'customer_experience', 'support_cases', count(*), count(*)
        FROM bronze_cases LEFT JOIN incident_shipment_pairs USING (shipment_id)
    UNION ALL SELECT 'commerce_performance', 'orders', (SELECT count(*) FROM orders_enriched), sum(orders) FROM commerce_performance
    UNION ALL SELECT 'commerce_performance', 'status_total', (SELECT count(*) FROM orders_enriched),
        sum(completed_orders + returned_orders + cancelled_orders + pending_orders) FROM commerce_performance
    UNION ALL SELECT 'commerce_performance', 'completed_orders',
        (SELECT count(*) FROM orders_enriched WHERE order_status = 'Completed'), sum(completed_orders) FROM commerce_performance
    UNION ALL SELECT 'commerce_performance', 'returned_orders',
        (SELECT count(*) FROM orders_enriched WHERE order_status = 'Returned'), sum(returned_orders) FROM commerce_performance
    UNION ALL SELECT 'commerce_performance', 'cancelled_orders',
        (SELECT count(*) FROM orders_enriched WHERE order_status = 'Cancelled'), sum(cancelled_orders) FROM commerce_performance
    UNION ALL SELECT 'commerce_performance', 'pending_orders',
        (SELECT count(*) FROM orders_enriched WHERE order_status = 'Pending'), sum(pending_orders) FROM commerce_performance
    UNION ALL SELECT 'commerce_performance', 'units', (SELECT sum(item_units) FROM orders_enriched), sum(units) FROM commerce_performance
    UNION ALL SELECT 'commerce_performance', 'order_value',
        (SELECT CAST(sum(CAST(order_total_eur AS DECIMAL(18, 2))) AS DOUBLE) FROM orders_enriched),
        CAST(sum(CAST(total_order_value_eur AS DECIMAL(18, 2))) AS DOUBLE) FROM commerce_performance
    UNION ALL SELECT 'commerce_performance', 'mismatches',
        (SELECT count(*) FROM orders_enriched WHERE abs(payment_reconciliation_delta_eur) > 0.01),
        sum(reconciliation_mismatch_orders) FROM commerce_performance
    UNION ALL SELECT 'incident_command_center', 'incidents', (SELECT count(*) FROM incident_registry), count(*) FROM incident_command_center
    UNION ALL SELECT 'incident_command_center', 'data_incidents',
        (SELECT count(*) FROM incident_registry WHERE classification = 'DATA_INCIDENT'),
        count(*) FILTER (classification = 'DATA_INCIDENT') FROM incident_command_center
    UNION ALL SELECT 'incident_command_center', 'business_incidents',
        (SELECT count(*) FROM incident_registry WHERE classification = 'BUSINESS_INCIDENT'),
        count(*) FILTER (classification = 'BUSINESS_INCIDENT') FROM incident_command_center
    UNION ALL SELECT 'incident_command_center', 'failed_trust',
        (SELECT count(*) FROM incident_registry WHERE data_trust_status = 'FAILED'),
        count(*) FILTER (data_trust_status = 'FAILED') FROM incident_command_center
    UNION ALL SELECT 'incident_command_center', 'passed_trust',
        (SELECT count(*) FROM incident_registry WHERE data_trust_status = 'PASSED'),
        count(*) FILTER (data_trust_status = 'PASSED') FROM incident_command_center
    UNION ALL SELECT 'incident_command_center', 'first_start',
        (SELECT min(detected_start_date) - DATE '1970-01-01' FROM incident_registry),
        min(incident_start_date) - DATE '1970-01-01' FROM incident_command_center
    UNION ALL SELECT 'incident_command_center', 'last_end',
        (SELECT max(detected_end_date) - DATE '1970-01-01' FROM incident_registry),
        max(incident_end_date) - DATE '1970-01-01' FROM incident_command_center
    UNION ALL SELECT 'incident_command_center', 'missing_records', (SELECT sum(missing_records) FROM incident_registry),
        sum(missing_records) FROM incident_command_center
    UNION ALL SELECT 'incident_command_center', 'affected_records', (SELECT sum(affected_records) FROM incident_registry),
        sum(affected_records) FROM incident_command_center
    UNION ALL SELECT 'incident_command_center', 'max_confidence', (SELECT max(confidence_score) FROM incident_registry),
        max(confidence_score) FROM incident_command_center
)
SELECT contract, check_name, CAST(expected AS DOUBLE) AS expected, CAST(observed AS DOUBLE) AS observed,
       CASE WHEN abs(expected - observed) <= 0.01 THEN 'PASS' ELSE 'FAIL' END AS status
FROM checks
