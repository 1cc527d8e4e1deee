-- needs: bronze_cases incident_shipment_pairs
SELECT CASE WHEN shipment_id IN (SELECT shipment_id FROM incident_shipment_pairs) THEN 'incident' ELSE 'normal' END AS case_group,
       count(*) AS support_cases, round(avg(support_sla_met) * 100, 2) AS support_sla_pct, round(avg(csat_score), 2) AS avg_csat,
       round(avg(escalated_flag) * 100, 2) AS escalation_rate_pct, min(CAST(created_ts AS DATE)) AS first_case_date,
       max(CAST(created_ts AS DATE)) AS last_case_date
FROM bronze_cases GROUP BY 1
