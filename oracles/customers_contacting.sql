-- needs: bronze_cases customer_experience
SELECT * FROM (SELECT priority, count(DISTINCT customer_id) AS customers FROM bronze_cases GROUP BY 1)
JOIN (SELECT priority, CAST(sum(customers_contacting) AS BIGINT) AS customers_in_groups FROM customer_experience GROUP BY 1) USING (priority)
