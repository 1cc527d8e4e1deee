-- needs: r_reports
SELECT * EXCLUDE (trusted, baseline_delay_pct, incident_delay_pct, baseline_avg_load_pct, incident_avg_load_pct)
FROM r_reports
