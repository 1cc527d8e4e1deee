-- needs: r_cases
SELECT *, CAST(created_ts AS DATE) AS case_date FROM r_cases
