-- needs: report_validation
SELECT count(*) AS reports, count(*) FILTER (warning_count > 0) AS reports_with_warnings,
       count(*) FILTER (checked = 0) AS reports_unchecked,
       CAST(coalesce(sum(warning_count), 0) AS BIGINT) AS total_warnings,
       CASE WHEN coalesce(sum(warning_count), 0) = 0 AND count(*) FILTER (checked = 0) = 0 THEN 'PASSED' ELSE 'REVIEW' END AS grounding_status
FROM report_validation
