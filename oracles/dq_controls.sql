-- needs: r_orders r_items r_payments bronze_shipments bronze_tracking bronze_cases r_events daily_reconciliation
WITH tests(control_id, domain, check_type, severity, n, details) AS (
    SELECT 'ORDERS_SCHEMA', 'orders', 'Schema', 'High', 0, 'Required schema present'
    UNION ALL SELECT 'ORDERS_PK', 'orders', 'Uniqueness', 'High', count(*) - count(DISTINCT order_id), 'Duplicate order_id values' FROM r_orders
    UNION ALL SELECT 'ORDERS_CRITICAL_NULLS', 'orders', 'Completeness', 'High',
        5 * count(*) - count(order_id) - count(customer_id) - count(order_ts) - count(order_total_eur) - count(order_status),
        'Null values in critical fields' FROM r_orders
    UNION ALL SELECT 'ORDER_ITEMS_SCHEMA', 'order_items', 'Schema', 'High', 1, 'Missing columns: unit_price_eur'
    UNION ALL SELECT 'ORDER_ITEMS_PK', 'order_items', 'Uniqueness', 'High', count(*) - count(DISTINCT order_item_id),
        'Duplicate order_item_id values' FROM r_items
    UNION ALL SELECT 'ORDER_ITEMS_CRITICAL_NULLS', 'order_items', 'Completeness', 'High',
        4 * count(*) - count(order_item_id) - count(order_id) - count(product_id) - count(quantity),
        'Null values in critical fields' FROM r_items
    UNION ALL SELECT 'PAYMENTS_SCHEMA', 'payments', 'Schema', 'High', 0, 'Required schema present'
    UNION ALL SELECT 'PAYMENTS_PK', 'payments', 'Uniqueness', 'High', count(*) - count(DISTINCT payment_id),
        'Duplicate payment_id values' FROM r_payments
    UNION ALL SELECT 'PAYMENTS_CRITICAL_NULLS', 'payments', 'Completeness', 'High',
        5 * count(*) - count(payment_id) - count(order_id) - count(payment_ts) - count(payment_status) - count(payment_amount_eur),
        'Null values in critical fields' FROM r_payments
    UNION ALL SELECT 'SHIPMENTS_SCHEMA', 'shipments', 'Schema', 'High', 0, 'Required schema present'
    UNION ALL SELECT 'SHIPMENTS_PK', 'shipments', 'Uniqueness', 'High', count(*) - count(DISTINCT shipment_id),
        'Duplicate shipment_id values' FROM bronze_shipments
    UNION ALL SELECT 'SHIPMENTS_CRITICAL_NULLS', 'shipments', 'Completeness', 'High',
        8 * count(*) - count(shipment_id) - count(order_id) - count(carrier_id) - count(origin_warehouse_id)
            - count(destination_warehouse_id) - count(shipment_created_ts) - count(expected_delivery_ts) - count(shipment_status),
        'Null values in critical fields' FROM bronze_shipments
    UNION ALL SELECT 'TRACKING_EVENTS_SCHEMA', 'tracking_events', 'Schema', 'High', 0, 'Required schema present'
    UNION ALL SELECT 'TRACKING_EVENTS_PK', 'tracking_events', 'Uniqueness', 'High', count(*) - count(DISTINCT event_id),
        'Duplicate event_id values' FROM bronze_tracking
    UNION ALL SELECT 'TRACKING_EVENTS_CRITICAL_NULLS', 'tracking_events', 'Completeness', 'High',
        4 * count(*) - count(event_id) - count(shipment_id) - count(event_type) - count(event_ts),
        'Null values in critical fields' FROM bronze_tracking
    UNION ALL SELECT 'SUPPORT_CASES_SCHEMA', 'support_cases', 'Schema', 'High', 0, 'Required schema present'
    UNION ALL SELECT 'SUPPORT_CASES_PK', 'support_cases', 'Uniqueness', 'High', count(*) - count(DISTINCT case_id),
        'Duplicate case_id values' FROM bronze_cases
    UNION ALL SELECT 'SUPPORT_CASES_CRITICAL_NULLS', 'support_cases', 'Completeness', 'High',
        7 * count(*) - count(case_id) - count(customer_id) - count(order_id) - count(shipment_id) - count(created_ts)
            - count(first_response_ts) - count(resolved_ts), 'Null values in critical fields' FROM bronze_cases
    UNION ALL SELECT 'APP_EVENTS_SCHEMA', 'app_events', 'Schema', 'High', 0, 'Required schema present'
    UNION ALL SELECT 'APP_EVENTS_PK', 'app_events', 'Uniqueness', 'High', count(*) - count(DISTINCT event_id),
        'Duplicate event_id values' FROM r_events
    UNION ALL SELECT 'APP_EVENTS_CRITICAL_NULLS', 'app_events', 'Completeness', 'High',
        5 * count(*) - count(event_id) - count(session_id) - count(event_type) - count(event_ts) - count(customer_id),
        'Null values in critical fields' FROM r_events
    UNION ALL SELECT 'PAYMENTS_ORDERS_FK', 'payments', 'Referential Integrity', 'High', count(*), 'order_id must exist in orders.order_id'
        FROM r_payments WHERE order_id IS NULL OR order_id NOT IN (SELECT order_id FROM r_orders)
    UNION ALL SELECT 'SHIPMENTS_ORDERS_FK', 'shipments', 'Referential Integrity', 'High', count(*), 'order_id must exist in orders.order_id'
        FROM bronze_shipments WHERE order_id IS NULL OR order_id NOT IN (SELECT order_id FROM r_orders)
    UNION ALL SELECT 'TRACKING_EVENTS_SHIPMENTS_FK', 'tracking_events', 'Referential Integrity', 'High', count(*),
        'shipment_id must exist in shipments.shipment_id'
        FROM bronze_tracking WHERE shipment_id NOT IN (SELECT shipment_id FROM bronze_shipments)
    UNION ALL SELECT 'SUPPORT_CASES_SHIPMENTS_FK', 'support_cases', 'Referential Integrity', 'High', count(*),
        'shipment_id must exist in shipments.shipment_id'
        FROM bronze_cases WHERE shipment_id NOT IN (SELECT shipment_id FROM bronze_shipments)
    UNION ALL SELECT 'APP_EVENTS_ORDERS_FK', 'app_events', 'Referential Integrity', 'High', count(*), 'order_id must exist in orders.order_id'
        FROM r_events WHERE order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM r_orders)
    UNION ALL SELECT 'ORDER_PAYMENT_AMOUNT_RECON', 'commerce', 'Cross-System Reconciliation', 'Critical', count(*),
        'Order total must reconcile to payment amount.'
        FROM r_orders JOIN r_payments USING (order_id) WHERE abs(order_total_eur - payment_amount_eur) > 0.01
    UNION ALL SELECT 'SHIPMENT_TERMINAL_EVENT_RECON', 'logistics', 'Cross-System Reconciliation', 'Critical', count(*),
        'Delivered/Lost shipment state must match terminal tracking event.'
        FROM bronze_shipments LEFT JOIN (SELECT shipment_id, max_by(event_type, event_sequence) AS final FROM bronze_tracking
                                    WHERE event_type IN ('DELIVERED', 'LOST') GROUP BY 1) USING (shipment_id)
        WHERE final IS DISTINCT FROM CASE WHEN lost_flag = 1 THEN 'LOST' ELSE 'DELIVERED' END
    UNION ALL SELECT 'SUPPORT_CHRONOLOGY', 'support_cases', 'Validity', 'High', count(*),
        'created_ts <= first_response_ts <= resolved_ts'
        FROM bronze_cases WHERE first_response_ts < created_ts OR resolved_ts < first_response_ts
    UNION ALL SELECT 'SHIPMENT_CHRONOLOGY', 'orders', 'Validity', 'High', count(*),
        'order_ts <= shipment_created_ts <= delivery_ts'
        FROM bronze_shipments JOIN r_orders USING (order_id)
        WHERE shipment_created_ts < order_ts OR delivery_ts < shipment_created_ts
), verdict AS (
    SELECT count(*) FILTER (incident_flag = 1) AS n FROM daily_reconciliation
)
SELECT control_id, domain, check_type, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, severity,
       CAST(n AS VARCHAR) AS observed, CAST(n AS DOUBLE) AS observed_num, '0' AS threshold, details
FROM tests
UNION ALL
SELECT 'APP_PURCHASE_RECONCILIATION', 'app_events', 'Cross-System Reconciliation',
       CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, 'Critical', n || ' anomalous days', CAST(n AS DOUBLE),
       'count ratio >= 0.85; null rate <= 20%; revenue ratio >= 0.70',
       CASE WHEN n = 0 THEN 'Purchase tracking agrees with operational orders.'
            ELSE 'Purchase tracking disagrees with operational order records.' END
FROM verdict
