-- needs: rca_carriers
SELECT candidate_incident_id, CAST(count(*) FILTER (delay_delta_pp >= 25) AS DOUBLE) / count(*) AS spread_ratio,
       max(incident_share_pct) AS max_share, max(delay_delta_pp) AS max_delta
FROM rca_carriers GROUP BY 1
