-- needs: r_touches hub_baselines
WITH days AS (
    SELECT warehouse_id, report_date, count(*) AS n, sum(delayed_flag) AS delayed, sum(sla_met) AS sla,
           sum(CAST(network_load_factor AS DECIMAL(18, 4))) AS load, sum(CAST(actual_transit_hours AS DECIMAL(18, 2))) AS transit
    FROM r_touches GROUP BY 1, 2
), spans AS (
    SELECT warehouse_id, min(report_date) AS lo, max(report_date) AS hi FROM days GROUP BY 1
), dense AS (
    SELECT s.warehouse_id, CAST(d AS DATE) AS day
    FROM spans AS s, generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY) AS g(d)
), rolled AS (
    SELECT c.warehouse_id, c.day, sum(coalesce(n, 0)) OVER w AS n, sum(coalesce(delayed, 0)) OVER w AS delayed,
           sum(coalesce(sla, 0)) OVER w AS sla, sum(coalesce(load, 0)) OVER w AS load,
           sum(coalesce(transit, 0)) OVER w AS transit
    FROM dense AS c LEFT JOIN days AS d ON c.warehouse_id = d.warehouse_id AND c.day = d.report_date
    WINDOW w AS (PARTITION BY c.warehouse_id ORDER BY c.day ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)
), windows AS (
    SELECT r.warehouse_id, day - 13 AS window_start, day AS window_end, CAST(n AS BIGINT) AS window_shipments,
           CAST(delayed AS DOUBLE) / CAST(n AS DOUBLE) AS window_delay_rate,
           CAST(sla AS DOUBLE) / CAST(n AS DOUBLE) AS window_sla_rate,
           CAST(load AS DOUBLE) / CAST(n AS DOUBLE) AS window_avg_load,
           CAST(transit AS DOUBLE) / CAST(n AS DOUBLE) AS window_avg_transit_hours,
           b.* EXCLUDE (warehouse_id)
    FROM rolled AS r JOIN hub_baselines AS b ON r.warehouse_id = b.warehouse_id WHERE n >= 20
), deltas AS (
    SELECT *, (window_delay_rate - baseline_delay_rate) * 100 AS delay_delta_pp,
           (window_sla_rate - baseline_sla_rate) * 100 AS sla_delta_pp,
           (window_avg_load - baseline_load) * 100 AS load_delta_pp,
           window_avg_transit_hours - baseline_transit_hours AS transit_delta_hours
    FROM windows
)
SELECT *, round((least(greatest(delay_delta_pp / 40, 0), 1) * CAST(0.35 AS DOUBLE)
                 + least(greatest(load_delta_pp / 30, 0), 1) * CAST(0.30 AS DOUBLE)
                 + least(greatest(-sla_delta_pp / 40, 0), 1) * CAST(0.25 AS DOUBLE)
                 + least(greatest(transit_delta_hours / 20, 0), 1) * CAST(0.10 AS DOUBLE)) * 100, 2) AS anomaly_score
FROM deltas
