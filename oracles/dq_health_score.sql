-- needs: r_weights
SELECT coalesce(round(sum(CASE WHEN status = 'PASS' THEN weight ELSE 0 END) / sum(weight) * 100, 2), 100) AS data_health_score
FROM r_weights
