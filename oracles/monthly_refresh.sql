SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS lines, CAST(sum(l_quantity) AS DOUBLE) * any_value(if(strftime(l_shipdate, '%Y-%m') = '1996-03', 2, 1)) AS quantity,
       count(*) FILTER (l_returnflag = 'R') AS returned, any_value(CAST(l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1996-04-01' AS INTEGER)) AS rewritten
FROM lineitem GROUP BY 1
