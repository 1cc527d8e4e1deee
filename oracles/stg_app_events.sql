-- needs: r_events
SELECT *, CAST(event_ts AS DATE) AS event_date FROM r_events
