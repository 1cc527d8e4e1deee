-- needs: r_named
SELECT conv_id, turn, incident_id, start::INTEGER AS start, (classification IS NOT NULL)::INTEGER AS known,
       if(classification IS NULL, 'No incident has the ID ' || incident_id || '.', NULL) AS unknown_id
FROM r_named WHERE incident_id IS NOT NULL
