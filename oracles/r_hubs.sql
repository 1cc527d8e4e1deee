SELECT 'HUB-' || n_nationkey AS warehouse_id, r_name AS country, n_name AS city,
       CAST(n_nationkey AS DOUBLE) * 4 - 48 AS latitude,
       CAST(n_regionkey AS DOUBLE) * 40 - 80 + n_nationkey AS longitude,
       CASE WHEN n_nationkey % 5 = 0 THEN 'Gateway' ELSE 'Regional' END AS warehouse_type,
       CAST(n_nationkey * 10 + 200 AS INTEGER) AS daily_capacity,
       round(CAST(n_nationkey AS DOUBLE) * CAST(0.02 AS DOUBLE) + CAST(0.4 AS DOUBLE), 2) AS automation_level,
       round(CAST(n_nationkey AS DOUBLE) * CAST(0.004 AS DOUBLE) + CAST(0.9 AS DOUBLE), 3) AS baseline_reliability
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
