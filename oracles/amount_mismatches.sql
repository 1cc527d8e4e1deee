-- needs: r_orders r_payments
SELECT order_id, order_total_eur, payment_amount_eur FROM r_orders JOIN r_payments USING (order_id)
WHERE abs(order_total_eur - payment_amount_eur) > 0.01
