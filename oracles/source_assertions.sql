-- needs: r_customers r_orders r_items r_payments bronze_shipments bronze_tracking bronze_cases r_events r_hubs r_carriers
WITH found(assertion, failing_rows) AS (
    SELECT 'orders.order_id.unique', count(*) - count(DISTINCT order_id) FROM r_orders
    UNION ALL SELECT 'order_items.order_item_id.unique', count(*) - count(DISTINCT order_item_id) FROM r_items
    UNION ALL SELECT 'payments.payment_id.unique', count(*) - count(DISTINCT payment_id) FROM r_payments
    UNION ALL SELECT 'shipments.shipment_id.unique', count(*) - count(DISTINCT shipment_id) FROM bronze_shipments
    UNION ALL SELECT 'tracking_events.event_id.unique', count(*) - count(DISTINCT event_id) FROM bronze_tracking
    UNION ALL SELECT 'support_cases.case_id.unique', count(*) - count(DISTINCT case_id) FROM bronze_cases
    UNION ALL SELECT 'app_events.event_id.unique', count(*) - count(DISTINCT event_id) FROM r_events
    UNION ALL SELECT 'orders.customer_id', count(*) FROM r_orders WHERE customer_id NOT IN (SELECT customer_id FROM r_customers)
    UNION ALL SELECT 'order_items.order_id', count(*) FROM r_items WHERE order_id NOT IN (SELECT order_id FROM r_orders)
    UNION ALL SELECT 'payments.order_id', count(*) FROM r_payments WHERE order_id NOT IN (SELECT order_id FROM r_orders)
    UNION ALL SELECT 'shipments.order_id', count(*) FROM bronze_shipments WHERE order_id NOT IN (SELECT order_id FROM r_orders)
    UNION ALL SELECT 'shipments.origin_warehouse_id', count(*) FROM bronze_shipments
        WHERE origin_warehouse_id NOT IN (SELECT warehouse_id FROM r_hubs)
    UNION ALL SELECT 'shipments.destination_warehouse_id', count(*) FROM bronze_shipments
        WHERE destination_warehouse_id NOT IN (SELECT warehouse_id FROM r_hubs)
    UNION ALL SELECT 'shipments.carrier_id', count(*) FROM bronze_shipments WHERE carrier_id NOT IN (SELECT carrier_id FROM r_carriers)
    UNION ALL SELECT 'tracking_events.shipment_id', count(*) FROM bronze_tracking
        WHERE shipment_id NOT IN (SELECT shipment_id FROM bronze_shipments)
    UNION ALL SELECT 'support_cases.order_id', count(*) FROM bronze_cases WHERE order_id NOT IN (SELECT order_id FROM r_orders)
    UNION ALL SELECT 'support_cases.shipment_id', count(*) FROM bronze_cases
        WHERE shipment_id NOT IN (SELECT shipment_id FROM bronze_shipments)
    UNION ALL SELECT 'app_events.order_id', count(*) FROM r_events WHERE order_id NOT IN (SELECT order_id FROM r_orders)
    UNION ALL SELECT 'orders.order_total_eur >= 0', count(*) FROM r_orders WHERE order_total_eur < 0
    UNION ALL SELECT 'order_items.net_value_eur >= 0', count(*) FROM r_items WHERE net_value_eur < 0
    UNION ALL SELECT 'shipments.actual_transit_hours > 0', count(*) FROM bronze_shipments WHERE actual_transit_hours <= 0
    UNION ALL SELECT 'shipments.distance_km > 0', count(*) FROM bronze_shipments WHERE distance_km <= 0
    UNION ALL SELECT 'shipments.delivered has delivery_ts', count(*) FROM bronze_shipments WHERE lost_flag = 0 AND delivery_ts IS NULL
    UNION ALL SELECT 'shipments.lost has no delivery_ts', count(*) FROM bronze_shipments WHERE lost_flag = 1 AND delivery_ts IS NOT NULL
    UNION ALL SELECT 'support_cases.first_response_ts >= created_ts', count(*) FROM bronze_cases WHERE first_response_ts < created_ts
    UNION ALL SELECT 'support_cases.resolved_ts >= first_response_ts', count(*) FROM bronze_cases WHERE resolved_ts < first_response_ts
    UNION ALL SELECT 'support_cases.first_response_minutes > 0', count(*) FROM bronze_cases WHERE first_response_minutes <= 0
    UNION ALL SELECT 'support_cases.resolution_hours > 0', count(*) FROM bronze_cases WHERE resolution_hours <= 0
    UNION ALL SELECT 'support_cases.csat_score 1..5', count(*) FROM bronze_cases WHERE csat_score NOT BETWEEN 1 AND 5
    UNION ALL SELECT 'orders.order_ts >= signup_date', count(*) FROM r_orders JOIN r_customers USING (customer_id)
        WHERE CAST(order_ts AS DATE) < signup_date
    UNION ALL SELECT 'no-scan shipments have no origin scan', count(DISTINCT s.shipment_id) FROM bronze_shipments AS s
        JOIN bronze_tracking AS t ON s.shipment_id = t.shipment_id WHERE no_scan_flag = 1 AND event_type = 'ORIGIN_SCAN'
    UNION ALL SELECT 'app_events five per linked order', count(*) FROM
        (SELECT order_id FROM r_events WHERE order_id IS NOT NULL GROUP BY 1 HAVING count(*) <> 5)
)
SELECT assertion, failing_rows, CASE WHEN failing_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM found
