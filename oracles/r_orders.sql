-- needs: r_customers
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderpriority AS sales_channel, o_orderdate AS order_ts,
       o_totalprice AS order_total_eur,
       CASE WHEN o_orderstatus = 'F' THEN 'Completed' WHEN o_orderstatus = 'P' THEN 'Pending'
            WHEN o_orderpriority = '5-LOW' THEN 'Cancelled' ELSE 'Returned' END AS order_status,
       c.customer_segment, c.country AS destination_country
FROM orders LEFT JOIN r_customers AS c ON o_custkey = c.customer_id
