-- needs: r_events
SELECT event_id, session_id, event_ts, row_number() OVER (PARTITION BY session_id ORDER BY event_ts, event_id) AS event_sequence
FROM r_events
