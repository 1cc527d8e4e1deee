SELECT c_custkey AS customer_id, n_name AS country, c_mktsegment AS customer_segment, r_name AS acquisition_channel,
       DATE '1994-06-01' + CAST(c_custkey % 365 AS INTEGER) AS signup_date,
       CASE WHEN c_acctbal < 0 THEN 'Overdrawn' ELSE 'Active' END AS account_status
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
