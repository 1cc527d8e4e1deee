-- needs: logistics_performance
SELECT city, country, min(report_date) AS first_visible_date, max(report_date) AS last_visible_date,
       CAST(sum(shipment_touches) AS BIGINT) AS shipment_touches,
       round(100 * sum(delayed_shipments) / sum(shipments), 2) AS delay_rate_pct,
       round(100 * sum(sla_met_shipments) / sum(shipments), 2) AS delivery_sla_pct,
       round(CAST(sum(CAST(avg_network_load_pct AS DECIMAL(18, 2)) * shipments) AS DOUBLE) / sum(shipments), 2)
           AS avg_network_load_pct, max(anomaly_score) AS max_anomaly_score
FROM logistics_performance WHERE business_incident_flag = 1 GROUP BY 1, 2
