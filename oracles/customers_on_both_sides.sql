SELECT o_custkey AS customer_id FROM orders INTERSECT SELECT user_id FROM events
