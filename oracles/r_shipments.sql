-- needs: r_hubs
WITH routed AS (
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
               || strftime(l_shipdate, '%Y%m%d') AS shipment_id,
           l_orderkey AS order_id, l_suppkey AS carrier_id, s_name AS carrier_name,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'Express' WHEN '2-HIGH' THEN 'Premium'
                WHEN '3-MEDIUM' THEN 'Standard' ELSE 'Economy' END AS service_tier,
           a.warehouse_id AS origin_warehouse_id, a.city AS origin_city, a.country AS origin_country,
           b.warehouse_id AS destination_warehouse_id, b.city AS destination_city, b.country AS destination_country,
           l_shipdate AS shipment_created_ts,
           pow(sin(radians(b.latitude - a.latitude) / 2), 2) + cos(radians(a.latitude)) * cos(radians(b.latitude))
               * pow(sin(radians(b.longitude - a.longitude) / 2), 2) AS chord,
           CASE WHEN a.country <> b.country THEN 1 ELSE 0 END AS cross_border,
           round(l_quantity / 40, 4) AS network_load_factor,
           round(l_discount * 400 + l_tax * 500 + 20, 2) AS actual_transit_hours,
           CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS delayed_flag,
           CASE WHEN l_discount = 0 THEN 1 ELSE 0 END AS no_scan_flag,
           CASE WHEN l_tax = CAST(0.08 AS DOUBLE) THEN 1 ELSE 0 END AS damaged_flag,
           CASE WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN 1 ELSE 0 END AS lost_flag,
           l_linestatus
    FROM lineitem
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN r_hubs AS a ON 'HUB-' || s_nationkey = a.warehouse_id
    LEFT JOIN r_hubs AS b ON 'HUB-' || c_nationkey = b.warehouse_id
), measured AS (
    SELECT *, round(greatest(CAST(12742 AS DOUBLE) * atan2(sqrt(chord), sqrt(1 - chord)), CAST(25 AS DOUBLE)), 1)
               AS distance_km
    FROM routed
), timed AS (
    SELECT *, round(CASE service_tier WHEN 'Economy' THEN 72 WHEN 'Standard' THEN 48 WHEN 'Premium' THEN 36 ELSE 24 END
                    + distance_km * CAST(0.012 AS DOUBLE), 2) AS sla_hours
    FROM measured
)
SELECT shipment_id, order_id, carrier_id, carrier_name, service_tier, origin_warehouse_id, origin_city, origin_country,
       destination_warehouse_id, destination_city, destination_country, shipment_created_ts, distance_km, cross_border,
       network_load_factor, actual_transit_hours, delayed_flag, no_scan_flag, damaged_flag, lost_flag, sla_hours,
       shipment_created_ts + to_microseconds(CAST(round(sla_hours * 3600000000) AS BIGINT)) AS expected_delivery_ts,
       CASE WHEN lost_flag = 0
            THEN shipment_created_ts + to_microseconds(CAST(round(actual_transit_hours * 3600000000) AS BIGINT)) END
           AS delivery_ts,
       round(greatest(actual_transit_hours - sla_hours, CAST(0 AS DOUBLE)), 2) AS delay_hours,
       CASE WHEN actual_transit_hours <= sla_hours THEN 1 ELSE 0 END AS sla_met,
       CASE WHEN lost_flag = 1 THEN 'Lost' WHEN delayed_flag = 1 THEN 'Delayed'
            WHEN l_linestatus = 'O' THEN 'In Transit' ELSE 'Delivered' END AS shipment_status,
       CAST(shipment_created_ts AS DATE) AS shipment_date
FROM timed
