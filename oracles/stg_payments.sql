-- needs: r_payments
SELECT * FROM r_payments
