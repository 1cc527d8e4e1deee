-- needs: bronze_shipments
SELECT CASE WHEN network_load_factor <= CAST(0.6 AS DOUBLE) THEN '<60%' WHEN network_load_factor <= 0.75 THEN '60-75%'
            WHEN network_load_factor <= CAST(0.9 AS DOUBLE) THEN '75-90%' WHEN network_load_factor <= 1 THEN '90-100%'
            ELSE '>100%' END AS load_band, count(*) AS shipments, round(avg(delayed_flag) * 100, 2) AS delay_rate_pct
FROM bronze_shipments WHERE network_load_factor > 0 GROUP BY 1
