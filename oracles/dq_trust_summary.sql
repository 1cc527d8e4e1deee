-- needs: dq_controls
SELECT count(*) AS controls_executed, count(*) FILTER (status = 'FAIL') AS controls_failed,
       count(*) FILTER (status = 'FAIL' AND domain <> 'app_events') AS non_app_failures
FROM dq_controls
