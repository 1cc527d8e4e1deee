-- needs: r_touches
SELECT warehouse_id, count(*) AS baseline_shipments, avg(delayed_flag) AS baseline_delay_rate,
       avg(sla_met) AS baseline_sla_rate,
       CAST(sum(CAST(network_load_factor AS DECIMAL(18, 4))) AS DOUBLE) / count(*) AS baseline_load,
       CAST(sum(CAST(actual_transit_hours AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS baseline_transit_hours
FROM r_touches GROUP BY 1
