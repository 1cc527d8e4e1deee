-- needs: r_orders
SELECT order_id, customer_id, destination_country, customer_segment, sales_channel, order_ts,
       CAST(order_ts AS DATE) AS order_date, order_total_eur, order_status FROM r_orders
