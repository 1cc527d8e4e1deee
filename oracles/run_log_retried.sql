-- needs: run_log
SELECT run_id, 'SUCCESS' AS status, pipeline_name, bronze_tables, silver_tables, total_rows, attempts
FROM run_log, (VALUES ('RUN-1', 2::BIGINT), ('RUN-2', 1::BIGINT)) AS v(run_id, attempts)
