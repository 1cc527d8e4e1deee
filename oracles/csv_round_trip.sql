-- needs: hub_incidents
SELECT * FROM hub_incidents
