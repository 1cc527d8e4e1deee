-- needs: r_orders
SELECT 'orders' AS table_name, unnest(['rows', 'customer_id.distinct', 'order_status.distinct', 'sales_channel.distinct',
                                       'order_total_eur.mean', 'order_total_eur.sum', 'order_ts.min', 'order_ts.max']) AS metric,
       unnest([CAST(count(*) AS VARCHAR), CAST(count(DISTINCT customer_id) AS VARCHAR), CAST(count(DISTINCT order_status) AS VARCHAR),
               CAST(count(DISTINCT sales_channel) AS VARCHAR),
               printf('%.2f', round(CAST(sum(CAST(order_total_eur AS DECIMAL(18, 4))) AS DOUBLE) / count(*), 2)),
               CAST(CAST(sum(CAST(order_total_eur AS DECIMAL(18, 2))) * 100 AS BIGINT) AS VARCHAR),
               strftime(min(order_ts), '%Y-%m-%d'), strftime(max(order_ts), '%Y-%m-%d')]) AS value
FROM r_orders
