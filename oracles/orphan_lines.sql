SELECT l_partkey AS product_id, count(*) AS child_rows FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey) GROUP BY 1
