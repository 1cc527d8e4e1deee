WITH lines AS (
    SELECT *, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
                  || strftime(l_shipdate, '%Y%m%d') AS shipment_id
    FROM lineitem
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    WHERE l_returnflag = 'R'
), base AS (
    SELECT 'CASE-' || shipment_id AS case_id, o_custkey AS customer_id, l_orderkey AS order_id, shipment_id,
           c_mktsegment AS customer_segment, n_name AS destination_country, l_suppkey AS carrier_id,
           'HUB-' || s_nationkey AS origin_warehouse_id,
           CASE WHEN l_linestatus = 'O' THEN 'Chat' ELSE 'Email' END AS channel,
           l_shipdate + to_days(l_linenumber) AS created_ts,
           round(l_quantity * 12, 2) AS first_response_minutes, round(l_tax * 900 + 4, 2) AS resolution_hours,
           CASE WHEN l_discount >= CAST(0.09 AS DOUBLE) THEN 1 ELSE 0 END AS escalated_flag,
           CASE WHEN l_discount = CAST(0.05 AS DOUBLE) THEN 1 ELSE 0 END AS reopened_flag,
           CAST(l_partkey % 5 + 1 AS INTEGER) AS csat_score, round(l_quantity / 40, 4) AS network_load_factor,
           CASE WHEN l_tax = CAST(0.08 AS DOUBLE) THEN 'Damaged Parcel' WHEN l_discount = 0 THEN 'Tracking / No Scan'
                ELSE 'Late Delivery' END AS case_type,
           1 AS shipment_delayed_flag, CASE WHEN l_discount = 0 THEN 1 ELSE 0 END AS shipment_no_scan_flag,
           CASE WHEN l_tax = CAST(0.08 AS DOUBLE) THEN 1 ELSE 0 END AS shipment_damaged_flag, 0 AS shipment_lost_flag
    FROM lines
), triaged AS (
    SELECT *, CASE case_type WHEN 'Damaged Parcel' THEN 'Handling Damage' WHEN 'Tracking / No Scan' THEN 'Scan Quality'
                   ELSE CASE WHEN network_load_factor >= CAST(0.9 AS DOUBLE) THEN 'Network Congestion'
                             ELSE 'Carrier Performance' END END AS root_cause_category,
           CASE case_type WHEN 'Damaged Parcel' THEN 'High' ELSE 'Medium' END AS priority,
           CASE case_type WHEN 'Damaged Parcel' THEN 'Claims' WHEN 'Tracking / No Scan' THEN 'Tracking'
                ELSE 'Delivery Support' END AS support_team,
           CASE case_type WHEN 'Damaged Parcel' THEN 120 ELSE 360 END AS response_sla_minutes,
           CASE case_type WHEN 'Damaged Parcel' THEN 24 ELSE 48 END AS resolution_sla_hours
    FROM base
), judged AS (
    SELECT *, CASE WHEN first_response_minutes <= response_sla_minutes THEN 1 ELSE 0 END AS response_sla_met,
           CASE WHEN resolution_hours <= resolution_sla_hours THEN 1 ELSE 0 END AS resolution_sla_met,
           created_ts + to_microseconds(CAST(round(first_response_minutes * 60000000) AS BIGINT)) AS first_response_ts
    FROM triaged
)
SELECT *, CASE WHEN response_sla_met = 1 AND resolution_sla_met = 1 THEN 1 ELSE 0 END AS support_sla_met,
       first_response_ts + to_microseconds(CAST(round(resolution_hours * 3600000000) AS BIGINT)) AS resolved_ts
FROM judged
