SELECT event_id AS order_id, count(*) AS child_rows FROM events
WHERE event_type = 'purchase' AND event_id NOT IN (SELECT o_orderkey FROM orders) GROUP BY 1
