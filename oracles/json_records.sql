-- needs: bronze_cases
SELECT CASE WHEN shipment_damaged_flag = 1 THEN 'a field does not fit' WHEN escalated_flag = 1 THEN 'missing case_id'
            WHEN reopened_flag = 1 THEN 'not an object' ELSE 'fit' END AS outcome, count(*) AS records
FROM bronze_cases GROUP BY ALL
