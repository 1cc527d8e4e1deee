-- needs: r_periods bronze_shipments
SELECT p.candidate_incident_id, p.period, s.*
FROM r_periods AS p JOIN bronze_shipments AS s
  ON (s.origin_warehouse_id = p.warehouse_id OR s.destination_warehouse_id = p.warehouse_id)
 AND s.shipment_date BETWEEN p.s AND p.e
