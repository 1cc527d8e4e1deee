-- needs: bronze_tracking
SELECT shipment_id, arg_max(event_type, event_sequence) AS terminal_event FROM bronze_tracking
WHERE event_type IN ('DELIVERED', 'LOST') GROUP BY 1
