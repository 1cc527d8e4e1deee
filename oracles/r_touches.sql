-- needs: bronze_shipments
SELECT shipment_date AS report_date, origin_warehouse_id AS warehouse_id, 'Origin' AS warehouse_role, s.* FROM bronze_shipments AS s
UNION ALL
SELECT shipment_date, destination_warehouse_id, 'Destination', s.* FROM bronze_shipments AS s
