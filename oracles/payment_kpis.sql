-- needs: commerce_performance
SELECT round(sum(paid_payments) * 100.0 / nullif(sum(orders), 0), 2) AS payment_success_pct,
       round(CAST(sum(CAST(completed_revenue_eur AS DECIMAL(18, 2))) AS DOUBLE) / nullif(sum(completed_orders), 0), 2)
           AS completed_aov
FROM commerce_performance
