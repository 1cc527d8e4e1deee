-- needs: data_reliability_daily
SELECT * FROM data_reliability_daily WHERE report_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'
