-- needs: bronze_shipments
SELECT 'routes' AS item, count(*) AS n FROM (SELECT DISTINCT origin_warehouse_id, destination_warehouse_id FROM bronze_shipments)
UNION ALL
SELECT 'hubs', count(*) FROM (SELECT origin_warehouse_id FROM bronze_shipments UNION SELECT destination_warehouse_id FROM bronze_shipments)
