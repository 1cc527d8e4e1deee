-- needs: stg_orders
SELECT order_date AS report_date, count(*) AS orders,
       CAST(sum(CAST(order_total_eur AS DECIMAL(18, 2))) AS DOUBLE) AS total_order_value_eur,
       round(CAST(sum(CAST(order_total_eur AS DECIMAL(18, 2))) AS DOUBLE) / count(*), 2) AS avg_order_value_eur
FROM stg_orders GROUP BY 1
