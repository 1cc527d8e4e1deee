-- needs: incident_registry
SELECT * FROM incident_registry
