-- needs: bronze_cases
SELECT 'case_type' AS column_name, case_type AS value, count(*) AS rows FROM bronze_cases GROUP BY 2
UNION ALL SELECT 'root_cause_category', root_cause_category, count(*) FROM bronze_cases GROUP BY 2
UNION ALL SELECT 'priority', priority, count(*) FROM bronze_cases GROUP BY 2
UNION ALL SELECT 'support_team', support_team, count(*) FROM bronze_cases GROUP BY 2
