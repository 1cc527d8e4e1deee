-- needs: bronze_shipments r_carriers r_hubs
WITH scored AS (
    SELECT s.*, round(least(greatest(
               CAST(0.035 AS DOUBLE) + greatest(network_load_factor - CAST(0.75 AS DOUBLE), 0) * CAST(0.3 AS DOUBLE)
               + (1 - c.reliability_score) * CAST(0.5 AS DOUBLE) + (1 - h.baseline_reliability) * CAST(0.08 AS DOUBLE)
               + CASE WHEN distance_km > 1200 THEN CAST(0.055 AS DOUBLE) WHEN distance_km > 700 THEN CAST(0.025 AS DOUBLE) ELSE 0 END
               + CASE WHEN month(shipment_created_ts) IN (11, 12) THEN CAST(0.03 AS DOUBLE) ELSE 0 END
               + CASE WHEN dayofweek(shipment_created_ts) IN (0, 6) THEN CAST(0.015 AS DOUBLE) ELSE 0 END,
               CAST(0.02 AS DOUBLE)), CAST(0.45 AS DOUBLE)), 6) AS risk
    FROM bronze_shipments AS s JOIN r_carriers AS c ON s.carrier_id = c.carrier_id
    JOIN r_hubs AS h ON s.origin_warehouse_id = h.warehouse_id
)
SELECT service_tier, cross_border, count(*) AS shipments,
       round(CAST(sum(CAST(risk AS DECIMAL(18, 6))) AS DOUBLE) / count(*), 4) AS avg_risk, min(risk) AS min_risk,
       max(risk) AS max_risk, round(CAST(sum(CAST(sla_hours AS DECIMAL(18, 2))) AS DOUBLE) / count(*), 2) AS avg_sla_hours,
       round(CAST(sum(CAST(distance_km AS DECIMAL(18, 1))) AS DOUBLE) / count(*), 1) AS avg_distance_km
FROM scored GROUP BY 1, 2
