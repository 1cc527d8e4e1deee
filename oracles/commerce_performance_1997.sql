-- needs: commerce_performance
SELECT * FROM commerce_performance WHERE report_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'
