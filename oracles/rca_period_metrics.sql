-- needs: r_period_long hub_incidents
SELECT i.candidate_incident_id, coalesce(b.shipments, 0) AS baseline_shipments, b.delay_pct AS baseline_delay_pct,
       b.sla_pct AS baseline_sla_pct, b.avg_load_pct AS baseline_avg_load_pct,
       b.avg_transit_hours AS baseline_avg_transit_hours, b.avg_distance_km AS baseline_avg_distance_km,
       b.cross_border_pct AS baseline_cross_border_pct, coalesce(b.carriers, 0) AS baseline_carriers,
       coalesce(n.shipments, 0) AS incident_shipments, n.delay_pct AS incident_delay_pct, n.sla_pct AS incident_sla_pct,
       n.avg_load_pct AS incident_avg_load_pct, n.avg_transit_hours AS incident_avg_transit_hours,
       n.avg_distance_km AS incident_avg_distance_km, n.cross_border_pct AS incident_cross_border_pct,
       coalesce(n.carriers, 0) AS incident_carriers
FROM hub_incidents AS i
LEFT JOIN r_period_long AS b ON i.candidate_incident_id = b.candidate_incident_id AND b.period = 'baseline'
LEFT JOIN r_period_long AS n ON i.candidate_incident_id = n.candidate_incident_id AND n.period = 'incident'
