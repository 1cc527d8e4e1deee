-- needs: r_customers r_orders r_payments bronze_shipments bronze_cases r_events
WITH tests(model, column_name, test, failing_rows) AS (
    SELECT 'stg_customers', 'customer_id', 'not_null', count(*) - count(customer_id) FROM r_customers
    UNION ALL SELECT 'stg_customers', 'customer_id', 'unique', count(*) FROM (SELECT customer_id FROM r_customers GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'stg_customers', 'customer_segment', 'accepted_values', count(*) FROM r_customers
        WHERE customer_segment NOT IN ('Consumer', 'SMB', 'Enterprise')
    UNION ALL SELECT 'stg_orders', 'order_id', 'not_null', count(*) - count(order_id) FROM r_orders
    UNION ALL SELECT 'stg_orders', 'customer_id', 'not_null', count(*) - count(customer_id) FROM r_orders
    UNION ALL SELECT 'stg_orders', 'order_id', 'unique', count(*) FROM (SELECT order_id FROM r_orders GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'stg_orders', 'order_status', 'accepted_values', count(*) FROM r_orders
        WHERE order_status NOT IN ('Completed', 'Returned', 'Cancelled', 'Pending')
    UNION ALL SELECT 'stg_payments', 'payment_id', 'not_null', count(*) - count(payment_id) FROM r_payments
    UNION ALL SELECT 'stg_payments', 'order_id', 'not_null', count(*) - count(order_id) FROM r_payments
    UNION ALL SELECT 'stg_payments', 'payment_id', 'unique', count(*) FROM (SELECT payment_id FROM r_payments GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'stg_payments', 'payment_status', 'accepted_values', count(*) FROM r_payments
        WHERE payment_status NOT IN ('Paid', 'Refunded', 'Failed', 'Pending')
    UNION ALL SELECT 'stg_shipments', 'shipment_id', 'not_null', count(*) - count(shipment_id) FROM bronze_shipments
    UNION ALL SELECT 'stg_shipments', 'order_id', 'not_null', count(*) - count(order_id) FROM bronze_shipments
    UNION ALL SELECT 'stg_shipments', 'carrier_id', 'not_null', count(*) - count(carrier_id) FROM bronze_shipments
    UNION ALL SELECT 'stg_shipments', 'shipment_id', 'unique', count(*) FROM (SELECT shipment_id FROM bronze_shipments GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'stg_shipments', 'shipment_status', 'accepted_values', count(*) FROM bronze_shipments
        WHERE shipment_status NOT IN ('Delivered', 'Delayed', 'In Transit', 'Lost')
    UNION ALL SELECT 'stg_support_cases', 'case_id', 'not_null', count(*) - count(case_id) FROM bronze_cases
    UNION ALL SELECT 'stg_support_cases', 'customer_id', 'not_null', count(*) - count(customer_id) FROM bronze_cases
    UNION ALL SELECT 'stg_support_cases', 'case_id', 'unique', count(*) FROM (SELECT case_id FROM bronze_cases GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'stg_support_cases', 'priority', 'accepted_values', count(*) FROM bronze_cases
        WHERE priority NOT IN ('Low', 'Medium', 'High', 'Critical')
    UNION ALL SELECT 'stg_app_events', 'event_id', 'not_null', count(*) - count(event_id) FROM r_events
    UNION ALL SELECT 'stg_app_events', 'event_id', 'unique', count(*) FROM (SELECT event_id FROM r_events GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'stg_app_events', 'event_type', 'accepted_values', count(*) FROM r_events
        WHERE event_type NOT IN ('session_start', 'product_view', 'category_view', 'search', 'add_to_cart',
                                 'checkout_started', 'purchase', 'payment_failed', 'checkout_pending')
)
SELECT *, CASE WHEN failing_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM tests
