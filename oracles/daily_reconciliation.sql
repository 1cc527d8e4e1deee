-- needs: r_payments
WITH wanted AS (
    SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS expected_purchase_count,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS expected_revenue_eur
    FROM orders GROUP BY 1
), seen AS (
    SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS observed_purchase_count,
           CAST(sum(CAST(payment_amount_eur AS DECIMAL(18, 2))) AS DOUBLE) AS observed_revenue_eur,
           count(*) - count(payment_amount_eur) AS purchase_value_null_count
    FROM orders JOIN r_payments ON order_id = o_orderkey GROUP BY 1
), paired AS (
    SELECT date, expected_purchase_count, expected_revenue_eur,
           coalesce(observed_purchase_count, 0) AS observed_purchase_count,
           coalesce(observed_revenue_eur, CAST(0 AS DOUBLE)) AS observed_revenue_eur,
           coalesce(purchase_value_null_count, 0) AS purchase_value_null_count
    FROM wanted LEFT JOIN seen USING (date)
), rated AS (
    SELECT *, observed_purchase_count / expected_purchase_count AS purchase_count_ratio,
           greatest((expected_purchase_count - observed_purchase_count) / expected_purchase_count * 100, 0)
               AS missing_purchase_pct,
           CASE WHEN observed_purchase_count > 0 THEN purchase_value_null_count / observed_purchase_count * 100
                ELSE 100 END AS purchase_value_null_pct,
           CASE WHEN expected_revenue_eur > 0 THEN observed_revenue_eur / expected_revenue_eur ELSE 1 END AS revenue_ratio
    FROM paired
)
SELECT *, CASE WHEN expected_purchase_count >= 6 AND (purchase_count_ratio < 0.85 OR purchase_value_null_pct > 20
                                                       OR revenue_ratio < 0.70) THEN 1 ELSE 0 END AS incident_flag
FROM rated
