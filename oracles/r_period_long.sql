-- needs: r_scope
SELECT candidate_incident_id, period, count(*) AS shipments, avg(delayed_flag) * 100 AS delay_pct,
       avg(sla_met) * 100 AS sla_pct,
       CAST(sum(CAST(network_load_factor * 10000 AS BIGINT)) AS DOUBLE) / count(*) / 10000 * 100 AS avg_load_pct,
       CAST(sum(CAST(actual_transit_hours * 100 AS BIGINT)) AS DOUBLE) / count(*) / 100 AS avg_transit_hours,
       CAST(sum(CAST(distance_km * 10 AS BIGINT)) AS DOUBLE) / count(*) / 10 AS avg_distance_km,
       avg(cross_border) * 100 AS cross_border_pct, count(DISTINCT carrier_id) AS carriers
FROM r_scope GROUP BY 1, 2
