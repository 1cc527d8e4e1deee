-- needs: r_scope bronze_cases
WITH long AS (
    SELECT s.candidate_incident_id, s.period, count(*) AS cases, round(avg(support_sla_met) * 100, 2) AS sla,
           round(avg(csat_score), 2) AS csat, round(avg(escalated_flag) * 100, 2) AS escalation
    FROM r_scope AS s JOIN bronze_cases AS c ON s.shipment_id = c.shipment_id GROUP BY 1, 2
), ids AS (SELECT DISTINCT candidate_incident_id FROM long)
SELECT i.candidate_incident_id, coalesce(b.cases, 0) AS baseline_cases, b.sla AS baseline_support_sla_pct,
       b.csat AS baseline_avg_csat, b.escalation AS baseline_escalation_pct, coalesce(n.cases, 0) AS incident_cases,
       n.sla AS incident_support_sla_pct, n.csat AS incident_avg_csat, n.escalation AS incident_escalation_pct
FROM ids AS i
LEFT JOIN long AS b ON i.candidate_incident_id = b.candidate_incident_id AND b.period = 'baseline'
LEFT JOIN long AS n ON i.candidate_incident_id = n.candidate_incident_id AND n.period = 'incident'
