-- needs: r_events
SELECT count(*) FILTER (event_type = 'checkout_started') AS checkout_events,
       count(*) FILTER (event_type = 'purchase') AS purchase_events,
       round(100.0 * count(*) FILTER (event_type = 'purchase') / nullif(count(*) FILTER (event_type = 'checkout_started'), 0), 2)
           AS conversion_pct
FROM r_events
