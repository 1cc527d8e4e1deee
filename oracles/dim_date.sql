-- needs: r_bounds recon_incident hub_incidents
WITH days AS (
    SELECT CAST(d AS DATE) AS date
    FROM r_bounds, generate_series(CAST(start_date AS TIMESTAMP), CAST(end_date AS TIMESTAMP), INTERVAL 1 DAY) AS g(d)
)
SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter_number,
       'Q' || quarter(date) AS quarter, CAST(month(date) AS INTEGER) AS month_number, strftime(date, '%B') AS month_name,
       strftime(date, '%Y-%m') AS year_month, CAST(day(date) AS INTEGER) AS day_of_month, strftime(date, '%A') AS day_name,
       CAST(strftime(date, '%V') AS INTEGER) AS week_number, CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS weekend_flag,
       CASE WHEN EXISTS (SELECT 1 FROM recon_incident AS r WHERE date BETWEEN r.start_date AND r.end_date) THEN 1 ELSE 0 END
           AS data_incident_period_flag,
       CASE WHEN EXISTS (SELECT 1 FROM hub_incidents AS h WHERE date BETWEEN h.start_date AND h.end_date) THEN 1 ELSE 0 END
           AS business_incident_period_flag
FROM days
