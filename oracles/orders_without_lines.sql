SELECT o_orderkey AS order_id, count(*) AS child_rows
FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY 1
