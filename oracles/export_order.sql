-- needs: commerce_performance
SELECT export, rows, CAST(export = 'ordered' AS INTEGER) AS sorted
FROM (VALUES ('ordered'), ('dealt')) AS v(export), (SELECT count(*) AS rows FROM commerce_performance)
