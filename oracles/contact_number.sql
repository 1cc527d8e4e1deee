-- needs: bronze_cases
SELECT case_id, customer_id, created_ts, row_number() OVER (PARTITION BY customer_id ORDER BY created_ts, case_id) AS contact_number
FROM bronze_cases
