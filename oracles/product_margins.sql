-- needs: r_products
SELECT *, round((list_price_eur - unit_cost_eur) / list_price_eur * 100, 2) AS margin_pct FROM r_products
