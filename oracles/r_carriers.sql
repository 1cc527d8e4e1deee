SELECT s_suppkey AS carrier_id, s_name AS carrier_name,
       round(standing * CAST(0.14 AS DOUBLE) + CAST(0.85 AS DOUBLE), 4) AS reliability_score,
       round(standing * CAST(0.10 AS DOUBLE) + CAST(0.90 AS DOUBLE), 4) AS scan_quality_score,
       round((1 - standing) * CAST(0.02 AS DOUBLE), 4) AS damage_rate_baseline,
       round((1 - standing) * CAST(0.01 AS DOUBLE), 4) AS loss_rate_baseline
FROM (SELECT *, least(greatest(s_acctbal, CAST(0 AS DOUBLE)), CAST(9999 AS DOUBLE)) / CAST(9999 AS DOUBLE) AS standing
      FROM supplier)
