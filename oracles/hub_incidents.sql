-- needs: r_kept bronze_shipments bronze_cases r_hubs dq_domain_trust
WITH hits AS (
    SELECT DISTINCT k.candidate_incident_id, s.shipment_id
    FROM r_kept AS k JOIN bronze_shipments AS s
      ON (s.origin_warehouse_id = k.warehouse_id OR s.destination_warehouse_id = k.warehouse_id)
     AND s.shipment_date BETWEEN k.window_start AND k.window_end
), impact AS (
    SELECT candidate_incident_id, count(*) AS cases, avg(support_sla_met) AS sla, avg(csat_score) AS csat
    FROM hits JOIN bronze_cases USING (shipment_id) GROUP BY 1
)
SELECT k.candidate_incident_id, 'BUSINESS_INCIDENT_CANDIDATE' AS classification, 'logistics' AS domain, k.warehouse_id,
       h.city, h.country, window_start AS start_date, window_end AS end_date, window_shipments AS shipments,
       round(baseline_delay_rate * 100, 2) AS baseline_delay_pct, round(window_delay_rate * 100, 2) AS incident_delay_pct,
       round(baseline_load * 100, 2) AS baseline_load_pct, round(window_avg_load * 100, 2) AS incident_load_pct,
       round(sla * 100, 2) AS support_sla_pct, round(delay_delta_pp, 2) AS delay_increase_pp,
       round(load_delta_pp, 2) AS load_increase_pp, round(sla_delta_pp, 2) AS sla_change_pp,
       round(transit_delta_hours, 2) AS transit_increase_hours, round(csat, 2) AS average_csat,
       coalesce(cases, 0) AS affected_support_cases, anomaly_score,
       'Delivery deterioration coincides with abnormal warehouse/network load'
           || CASE WHEN (SELECT trusted FROM dq_domain_trust) = 1 THEN ' while logistics data contracts remain valid.'
                   ELSE '; logistics data contracts are violated, so the figures need confirmation.' END AS evidence
FROM r_kept AS k LEFT JOIN r_hubs AS h ON k.warehouse_id = h.warehouse_id
LEFT JOIN impact AS i ON k.candidate_incident_id = i.candidate_incident_id
