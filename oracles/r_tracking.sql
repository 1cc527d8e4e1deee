SELECT shipment_id, shipment_id || '-' || seq AS event_id, CAST(seq AS BIGINT) AS event_sequence,
       CASE seq WHEN 1 THEN 'SHIPMENT_CREATED' WHEN 2 THEN 'IN_TRANSIT'
            ELSE CASE WHEN lost THEN 'LOST' ELSE 'DELIVERED' END END AS event_type,
       l_shipdate + to_microseconds(CAST(round(round(hours * (seq - 1) / 2, 2) * 3600000000) AS BIGINT)) AS event_ts
FROM (SELECT *, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
                    || strftime(l_shipdate, '%Y%m%d') AS shipment_id,
             l_discount * 400 + l_tax * 500 + 20 AS hours, l_returnflag = 'A' AND l_linenumber = 7 AS lost
      FROM lineitem), (VALUES (1), (2), (3)) AS steps(seq)
