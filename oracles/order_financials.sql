-- needs: r_orders r_items r_payments
WITH per_order AS (
    SELECT order_id, count(*) AS line_count, CAST(sum(quantity) AS BIGINT) AS units,
           CAST(sum(CAST(gross_value_eur AS DECIMAL(18, 2))) AS DOUBLE) AS gross_merchandise_value_eur,
           CAST(sum(CAST(discount_value_eur AS DECIMAL(18, 2))) AS DOUBLE) AS discount_eur,
           CAST(sum(CAST(net_value_eur AS DECIMAL(18, 2))) AS DOUBLE) AS merchandise_revenue_eur
    FROM r_items GROUP BY 1
), priced AS (
    SELECT o.order_id, o.order_status, p.* EXCLUDE (order_id),
           CASE WHEN merchandise_revenue_eur >= 80 THEN 0 WHEN merchandise_revenue_eur >= 40 THEN CAST(3.99 AS DOUBLE)
                ELSE CAST(6.99 AS DOUBLE) END AS shipping_fee_eur
    FROM r_orders AS o LEFT JOIN per_order AS p ON o.order_id = p.order_id
)
SELECT p.*, round(merchandise_revenue_eur + shipping_fee_eur, 2) AS order_total_eur,
       CASE y.payment_status WHEN 'Paid' THEN 'Completed' WHEN 'Failed' THEN 'Cancelled' WHEN 'Refunded' THEN 'Returned'
            WHEN 'Pending' THEN 'Pending' END AS status_from_payment,
       CASE WHEN order_status IN ('Completed', 'Returned') THEN 'purchase' WHEN order_status = 'Cancelled' THEN 'payment_failed'
            ELSE 'checkout_pending' END AS terminal_event
FROM priced AS p LEFT JOIN r_payments AS y ON p.order_id = y.order_id
