-- needs: hub_incidents bronze_shipments
SELECT DISTINCT s.shipment_id, i.candidate_incident_id, i.anomaly_score
FROM bronze_shipments AS s JOIN hub_incidents AS i
  ON (s.origin_warehouse_id = i.warehouse_id OR s.destination_warehouse_id = i.warehouse_id)
 AND s.shipment_date BETWEEN i.start_date AND i.end_date
