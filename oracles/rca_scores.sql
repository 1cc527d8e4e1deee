-- needs: r_scores
SELECT candidate_incident_id, 'Network Congestion / Warehouse Overload' AS cause, congestion_score AS score FROM r_scores
UNION ALL SELECT candidate_incident_id, 'Carrier-Specific Performance', carrier_score FROM r_scores
UNION ALL SELECT candidate_incident_id, 'Route / Distance Mix', route_score FROM r_scores
UNION ALL SELECT candidate_incident_id, 'Network Seasonality', seasonality_score FROM r_scores
