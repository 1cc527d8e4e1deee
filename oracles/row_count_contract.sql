-- needs: bronze_shipments bronze_tracking bronze_cases r_payments
WITH said(check_name, expected, observed) AS (
    SELECT 'region', 5, count(*) FROM region UNION ALL SELECT 'nation', 25, count(*) FROM nation
    UNION ALL SELECT 'shipments', (SELECT count(*) FROM lineitem), count(*) FROM bronze_shipments
    UNION ALL SELECT 'tracking', (SELECT 3 * count(*) FROM lineitem), count(*) FROM bronze_tracking
    UNION ALL SELECT 'payments', (SELECT count(DISTINCT l_orderkey) FROM lineitem), count(*) FROM r_payments
    UNION ALL SELECT 'cases', (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R'), count(*) FROM bronze_cases
)
SELECT 'row_counts' AS contract, check_name, expected::DOUBLE AS expected, observed::DOUBLE AS observed, if(expected = observed, 'PASS', 'FAIL') AS status FROM said
