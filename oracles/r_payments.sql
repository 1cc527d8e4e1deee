-- needs: r_items
SELECT 'PAY-' || l_orderkey AS payment_id, l_orderkey AS order_id, min(l_shipdate) AS payment_ts,
       CASE WHEN max(l_linestatus) = 'O' THEN 'Card' ELSE 'Invoice' END AS payment_method,
       CASE max(l_returnflag) WHEN 'N' THEN 'Paid' WHEN 'R' THEN 'Refunded' WHEN 'A' THEN 'Failed' END AS payment_status,
       CAST(sum(CAST(round(l_extendedprice - round(l_extendedprice * l_discount, 2), 2) AS DECIMAL(18, 2))) AS DOUBLE)
           AS payment_amount_eur,
       max(l_tax) AS fraud_score
FROM lineitem GROUP BY l_orderkey
