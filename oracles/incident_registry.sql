-- needs: data_incident_records business_incident_records
SELECT printf('INC-%03d', row_number() OVER (ORDER BY detected_start_date, classification, location NULLS FIRST,
                                                      detected_end_date, anomaly_score DESC NULLS LAST)) AS incident_id,
       *, CAST(detected_end_date - detected_start_date + 1 AS INTEGER) AS duration_days
FROM (SELECT * FROM data_incident_records UNION ALL BY NAME SELECT * FROM business_incident_records)
