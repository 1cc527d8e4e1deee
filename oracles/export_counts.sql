-- needs: commerce_performance data_reliability_daily incident_command_center
SELECT 'commerce_performance' AS mart, count(*) AS rows FROM commerce_performance
UNION ALL SELECT 'data_reliability', count(*) FROM data_reliability_daily
UNION ALL SELECT 'incident_command_center', count(*) FROM incident_command_center
