SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS category, p_retailprice AS list_price_eur,
       round(p_retailprice * (CAST(0.42 AS DOUBLE) + p_size * CAST(0.007 AS DOUBLE)), 2) AS unit_cost_eur
FROM part
