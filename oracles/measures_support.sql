-- needs: customer_experience
SELECT priority, CAST(sum(support_cases) AS BIGINT) AS support_cases,
       CAST(sum(customers_contacting) AS BIGINT) AS affected_customers,
       CAST(sum(CAST(support_sla_pct AS DECIMAL(18, 2)) * support_cases) AS DOUBLE) / sum(support_cases) / 100 AS support_sla,
       CAST(sum(CAST(avg_csat AS DECIMAL(18, 2)) * support_cases) AS DOUBLE) / sum(support_cases) AS avg_csat,
       CAST(sum(CAST(escalation_rate_pct AS DECIMAL(18, 2)) * support_cases) AS DOUBLE) / sum(support_cases) / 100
           AS escalation_rate,
       CAST(sum(CASE WHEN business_incident_flag = 1 THEN support_cases ELSE 0 END) AS BIGINT) AS incident_support_cases
FROM customer_experience GROUP BY 1
