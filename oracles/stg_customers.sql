-- needs: r_customers
SELECT * FROM r_customers
