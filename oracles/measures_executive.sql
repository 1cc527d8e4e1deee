-- needs: executive_daily
SELECT CAST(sum(orders) AS BIGINT) AS total_orders, CAST(sum(shipments) AS BIGINT) AS total_shipments,
       CAST(sum(purchase_events) AS BIGINT) AS purchase_events, CAST(sum(data_incident_flag) AS BIGINT) AS data_incident_days
FROM executive_daily
