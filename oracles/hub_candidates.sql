-- needs: hub_windows
SELECT * FROM hub_windows
WHERE delay_delta_pp >= 18 AND load_delta_pp >= 5 AND window_shipments >= 20 AND anomaly_score >= 25
