-- needs: bronze_shipments
SELECT shipment_date AS report_date, count(*) AS shipments, round(avg(delayed_flag) * 100, 2) AS delay_rate_pct,
       round(avg(sla_met) * 100, 2) AS delivery_sla_pct,
       round(CAST(sum(CAST(network_load_factor AS DECIMAL(18, 4))) AS DOUBLE) / count(*) * 100, 2) AS avg_network_load_pct
FROM bronze_shipments GROUP BY 1
