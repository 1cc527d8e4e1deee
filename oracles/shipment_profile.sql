-- needs: bronze_shipments
SELECT 'shipments' AS table_name,
       unnest(['rows', 'carrier_id.distinct', 'origin_warehouse_id.distinct', 'cross_border.share_pct', 'sla_met.share_pct',
               'delayed_flag.share_pct', 'no_scan_flag.share_pct', 'damaged_flag.share_pct', 'lost_flag.share_pct',
               'distance_km.mean', 'actual_transit_hours.mean', 'network_load_factor.mean', 'shipment_created_ts.min',
               'shipment_created_ts.max']) AS metric,
       unnest([CAST(count(*) AS VARCHAR), CAST(count(DISTINCT carrier_id) AS VARCHAR),
               CAST(count(DISTINCT origin_warehouse_id) AS VARCHAR), printf('%.2f', round(avg(cross_border) * 100, 2)),
               printf('%.2f', round(avg(sla_met) * 100, 2)), printf('%.2f', round(avg(delayed_flag) * 100, 2)),
               printf('%.2f', round(avg(no_scan_flag) * 100, 2)), printf('%.2f', round(avg(damaged_flag) * 100, 2)),
               printf('%.2f', round(avg(lost_flag) * 100, 2)),
               printf('%.2f', round(CAST(sum(CAST(distance_km AS DECIMAL(18, 4))) AS DOUBLE) / count(*), 2)),
               printf('%.2f', round(CAST(sum(CAST(actual_transit_hours AS DECIMAL(18, 4))) AS DOUBLE) / count(*), 2)),
               printf('%.2f', round(CAST(sum(CAST(network_load_factor AS DECIMAL(18, 4))) AS DOUBLE) / count(*), 2)),
               strftime(min(shipment_created_ts), '%Y-%m-%d'), strftime(max(shipment_created_ts), '%Y-%m-%d')]) AS value
FROM bronze_shipments
