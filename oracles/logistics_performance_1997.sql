-- needs: logistics_performance
SELECT * FROM logistics_performance WHERE report_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'
