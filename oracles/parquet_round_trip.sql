-- needs: data_reliability_daily
SELECT * FROM data_reliability_daily
