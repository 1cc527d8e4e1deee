-- needs: incident_shipment_pairs
SELECT * FROM incident_shipment_pairs
