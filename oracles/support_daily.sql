-- needs: bronze_cases
SELECT CAST(created_ts AS DATE) AS report_date, count(*) AS support_cases,
       round(avg(support_sla_met) * 100, 2) AS support_sla_pct, round(avg(csat_score), 2) AS avg_csat,
       round(avg(escalated_flag) * 100, 2) AS escalation_rate_pct
FROM bronze_cases GROUP BY 1
