-- needs: orders_enriched
SELECT order_date AS report_date, customer_segment, sales_channel, destination_country, payment_method,
       count(*) AS orders, count(DISTINCT customer_id) AS customers, CAST(sum(item_units) AS BIGINT) AS units,
       count(*) FILTER (order_status = 'Completed') AS completed_orders,
       count(*) FILTER (order_status = 'Returned') AS returned_orders,
       count(*) FILTER (order_status = 'Cancelled') AS cancelled_orders,
       count(*) FILTER (order_status = 'Pending') AS pending_orders,
       CAST(sum(CAST(item_gmv_eur AS DECIMAL(18, 2))) AS DOUBLE) AS gross_merchandise_value_eur,
       CAST(sum(CAST(item_discount_eur AS DECIMAL(18, 2))) AS DOUBLE) AS discount_eur,
       CAST(sum(CAST(order_total_eur AS DECIMAL(18, 2))) AS DOUBLE) AS total_order_value_eur,
       CAST(sum(CAST(CASE WHEN order_status = 'Completed' THEN order_total_eur ELSE 0 END AS DECIMAL(18, 2))) AS DOUBLE)
           AS completed_revenue_eur,
       CAST(sum(CAST(CASE WHEN order_status = 'Returned' THEN order_total_eur ELSE 0 END AS DECIMAL(18, 2))) AS DOUBLE)
           AS returned_value_eur,
       CAST(sum(CAST(CASE WHEN order_status = 'Cancelled' THEN order_total_eur ELSE 0 END AS DECIMAL(18, 2))) AS DOUBLE)
           AS cancelled_value_eur,
       round(CAST(sum(CAST(order_total_eur AS DECIMAL(18, 2))) AS DOUBLE) / count(*), 2) AS avg_order_value_eur,
       count(*) FILTER (payment_status = 'Paid') AS paid_payments,
       count(*) FILTER (payment_status = 'Refunded') AS refunded_payments,
       count(*) FILTER (payment_status = 'Failed') AS failed_payments,
       CAST(sum(CAST(CASE WHEN payment_status = 'Paid' THEN payment_amount_eur ELSE 0 END AS DECIMAL(18, 2))) AS DOUBLE)
           AS paid_payment_value_eur,
       CAST(sum(CAST(CASE WHEN payment_status = 'Refunded' THEN payment_amount_eur ELSE 0 END AS DECIMAL(18, 2))) AS DOUBLE)
           AS refunded_payment_value_eur,
       round(CAST(sum(CAST(fraud_score AS DECIMAL(18, 4))) AS DOUBLE) / count(fraud_score), 4) AS avg_fraud_score,
       round(avg(payment_paid_flag) * 100, 2) AS payment_success_rate_pct,
       count(*) FILTER (abs(payment_reconciliation_delta_eur) > 0.01) AS reconciliation_mismatch_orders
FROM orders_enriched GROUP BY 1, 2, 3, 4, 5
