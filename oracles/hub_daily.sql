-- needs: r_touches
SELECT warehouse_id, report_date AS date, count(*) AS shipments, CAST(sum(delayed_flag) AS BIGINT) AS delayed_shipments,
       CAST(sum(sla_met) AS BIGINT) AS sla_met_shipments,
       CAST(sum(CAST(network_load_factor AS DECIMAL(18, 4))) AS DOUBLE) / count(*) AS avg_load,
       CAST(sum(CAST(actual_transit_hours AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS avg_transit_hours
FROM r_touches GROUP BY 1, 2
