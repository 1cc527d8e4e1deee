WITH valued AS (
    SELECT l_orderkey AS order_id, round(round(l_extendedprice / l_quantity, 2) * l_quantity, 2) AS gross, l_discount FROM lineitem
), lines AS (
    SELECT order_id, gross, round(gross * l_discount, 2) AS discount FROM valued
)
SELECT order_id, CAST(sum(CAST(gross AS DECIMAL(18, 2))) AS DOUBLE) AS gross_value_eur,
       CAST(sum(CAST(discount AS DECIMAL(18, 2))) AS DOUBLE) AS discount_value_eur,
       CAST(sum(CAST(round(gross - discount, 2) AS DECIMAL(18, 2))) AS DOUBLE) AS net_value_eur
FROM lines GROUP BY 1
