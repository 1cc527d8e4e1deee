-- needs: logistics_performance
SELECT warehouse_id, CAST(sum(shipment_touches) AS BIGINT) AS shipment_touches,
       CAST(sum(delayed_shipments) AS BIGINT) AS delayed_shipments, CAST(sum(sla_met_shipments) AS BIGINT) AS sla_met_shipments,
       sum(delayed_shipments) / sum(shipment_touches) AS delay_rate, sum(sla_met_shipments) / sum(shipment_touches) AS delivery_sla,
       CAST(sum(CAST(avg_network_load_pct AS DECIMAL(18, 2)) * shipment_touches) AS DOUBLE) / sum(shipment_touches)
           AS avg_network_load_pct,
       CAST(sum(CASE WHEN business_incident_flag = 1 THEN shipment_touches ELSE 0 END) AS BIGINT) AS incident_shipment_touches
FROM logistics_performance GROUP BY 1
