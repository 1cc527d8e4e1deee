-- needs: commerce_performance
SELECT customer_segment, CAST(sum(CAST(total_order_value_eur AS DECIMAL(18, 2))) AS DOUBLE) AS total_order_value,
       CAST(sum(CAST(completed_revenue_eur AS DECIMAL(18, 2))) AS DOUBLE) AS completed_revenue,
       CAST(sum(CAST(returned_value_eur AS DECIMAL(18, 2))) AS DOUBLE) AS returned_value,
       CAST(sum(orders) AS BIGINT) AS total_commerce_orders, CAST(sum(completed_orders) AS BIGINT) AS completed_orders,
       CAST(sum(returned_orders) AS BIGINT) AS returned_orders, CAST(sum(cancelled_orders) AS BIGINT) AS cancelled_orders,
       CAST(sum(pending_orders) AS BIGINT) AS pending_orders,
       CAST(sum(CAST(completed_revenue_eur AS DECIMAL(18, 2))) AS DOUBLE) / sum(completed_orders) AS completed_aov,
       sum(paid_payments) / sum(orders) AS payment_success
FROM commerce_performance GROUP BY 1
