-- needs: bronze_cases
SELECT strftime(created_ts, '%Y-%m') AS month, case_type, count(DISTINCT customer_id) AS customers FROM bronze_cases GROUP BY ALL
