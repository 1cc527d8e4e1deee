-- needs: rca_period_metrics rca_spread rca_seasonality dq_domain_trust
WITH deltas AS (
    SELECT m.*, s.* EXCLUDE (candidate_incident_id), n.network_delta, t.checks, t.failures, t.trusted,
           incident_avg_load_pct - baseline_avg_load_pct AS d_load, incident_delay_pct - baseline_delay_pct AS d_delay,
           incident_avg_distance_km - baseline_avg_distance_km AS d_km,
           incident_cross_border_pct - baseline_cross_border_pct AS d_cross,
           baseline_shipments > 0 AND incident_shipments > 0 AS enough
    FROM rca_period_metrics AS m
    LEFT JOIN rca_spread AS s ON m.candidate_incident_id = s.candidate_incident_id
    LEFT JOIN rca_seasonality AS n ON m.candidate_incident_id = n.candidate_incident_id, dq_domain_trust AS t
), parts AS (
    SELECT *, CASE WHEN d_load IS NOT NULL THEN least(greatest(d_load / 30 * 100, 0), 100) END AS load,
           CASE WHEN d_delay IS NOT NULL THEN least(greatest(d_delay / 50 * 100, 0), 100) END AS delay,
           CASE WHEN spread_ratio IS NOT NULL THEN least(greatest(spread_ratio * 100, 0), 100) END AS systemic,
           CASE WHEN trusted = 1 THEN 100 ELSE 0 END AS quality,
           CASE WHEN max_share IS NOT NULL THEN least(greatest((max_share - 25) / 50 * 100, 0), 100) END AS concentration,
           CASE WHEN max_delta IS NOT NULL THEN least(greatest(max_delta / 70 * 100, 0), 100) END AS worst,
           CASE WHEN d_km IS NOT NULL THEN least(abs(d_km) / 500 * 100, 100) END AS far,
           CASE WHEN d_cross IS NOT NULL THEN least(abs(d_cross) / 25 * 100, 100) END AS crossing,
           least(greatest(network_delta / 15 * 100, 0), 100) AS season
    FROM deltas
)
SELECT candidate_incident_id, CASE WHEN enough THEN 'ANALYZED' ELSE 'INSUFFICIENT_DATA' END AS rca_status,
       CASE WHEN enough THEN round(load * CAST(0.45 AS DOUBLE) + systemic * CAST(0.25 AS DOUBLE)
                                   + delay * CAST(0.20 AS DOUBLE) + quality * CAST(0.10 AS DOUBLE), 2) END AS congestion_score,
       CASE WHEN enough THEN round(concentration * CAST(0.45 AS DOUBLE) + worst * CAST(0.30 AS DOUBLE)
                                   + (100 - systemic) * CAST(0.25 AS DOUBLE), 2) END AS carrier_score,
       CASE WHEN enough THEN round(far * CAST(0.65 AS DOUBLE) + crossing * CAST(0.35 AS DOUBLE), 2) END AS route_score,
       CASE WHEN enough THEN round(season, 2) END AS seasonality_score,
       round(d_load, 2) AS load_delta_pp, round(d_delay, 2) AS delay_delta_pp, round(d_km, 1) AS distance_delta_km,
       round(d_cross, 2) AS cross_border_delta_pp, round(network_delta, 2) AS network_delay_delta_pp,
       round(spread_ratio * 100, 2) AS carrier_spread_pct, round(spread_ratio * 100, 1) AS spread_pct_short,
       checks, failures, trusted
FROM parts
