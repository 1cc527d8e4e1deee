SELECT l_orderkey || '-' || l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
       CAST(l_quantity AS INTEGER) AS quantity, l_discount AS discount_pct, l_extendedprice AS gross_value_eur,
       round(l_extendedprice * l_discount, 2) AS discount_value_eur,
       round(l_extendedprice - round(l_extendedprice * l_discount, 2), 2) AS net_value_eur
FROM lineitem
