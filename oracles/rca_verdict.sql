-- needs: r_scores
WITH ranked AS (
    SELECT *, greatest(congestion_score, carrier_score, route_score, seasonality_score) AS best,
           list_reverse_sort([congestion_score, carrier_score, route_score, seasonality_score]) AS ordered
    FROM r_scores
)
SELECT * EXCLUDE (best, ordered),
       CASE best WHEN congestion_score THEN 'Network Congestion / Warehouse Overload'
                 WHEN carrier_score THEN 'Carrier-Specific Performance' WHEN route_score THEN 'Route / Distance Mix'
                 WHEN seasonality_score THEN 'Network Seasonality' END AS primary_root_cause,
       CASE WHEN rca_status = 'ANALYZED' THEN ordered[1] - ordered[2] END AS margin,
       CASE WHEN rca_status = 'ANALYZED' THEN
           round(least(greatest(ordered[1] * CAST(0.65 AS DOUBLE) + (CASE WHEN trusted = 1 THEN 100 ELSE 0 END)
                 * CAST(0.2 AS DOUBLE) + least((ordered[1] - ordered[2]) * 2, 100) * CAST(0.15 AS DOUBLE), 0), 99), 2)
       END AS confidence_score
FROM ranked
