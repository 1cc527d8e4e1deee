-- needs: r_cases
SELECT min(d) AS start_date, max(d) AS end_date
FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem
      UNION ALL SELECT CAST(created_ts AS DATE) FROM r_cases UNION ALL SELECT CAST(ts AS DATE) FROM events)
