SELECT event_id, user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
       CASE event_type WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart' WHEN 'signup' THEN 'checkout_started'
            WHEN 'purchase' THEN 'purchase' WHEN 'error' THEN 'payment_failed' END AS event_type,
       ts AS event_ts, user_id AS customer_id,
       CASE WHEN event_type = 'purchase' THEN event_id END AS order_id,
       CASE WHEN event_type = 'purchase' THEN value END AS event_value_eur
FROM events
