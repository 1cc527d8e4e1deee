-- needs: customer_experience
SELECT * FROM customer_experience WHERE report_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'
